r"""PII surrogates, with DataFrame functions only.

Detected entities receive replacements made from a keyed hash: type-consistent (an address stays
an address, a valid card number stays valid), of the same format (lengths, separators, case,
country code) and, for people, of the same gender and script.  Two spellings of one entity share a
canonical form and hence a replacement, in all documents; surnames and given names are replaced
each by itself, so that "Ms Anna Smith" and a later "Smith" still agree.  Replacements are checked:
no two canonical forms of a kind may share one, and none may be a real one (for names: no two given
names or surnames, and no real name of either sort).  What collides is hashed again; where a format
has too few values left, the replacement becomes longer, and names get more syllables, so that any
number of forms settles.

Documents without an entity pass unchanged and are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import attach, documents, materialize, prepare

KEY = "surrogate-key"          # production callers pass their own
ROUNDS = 60
WIDEN = 3                      # attempts in the same format; then a character more each time

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
TITLES = {"m": r"Mr|Herr|Monsieur|Señor|Г-н|Господин", "f": r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Г-жа|Госпожа"}
NAME = r"\p{Lu}\p{L}{1,30}"
KINDS = {  # in the order in which a match is given its kind
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]{1,64}+@(?:[\p{L}\p{N}\-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": r"(?<![\p{L}\p{N}])(?i:password|passwd|pwd|secret|token|api[_\-]?key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
              r"(?=[A-Za-z_\-./+]{0,60}\d)[A-Za-z0-9_\-./+]{6,128}",
    "cloud_key": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "ipv4": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d+\-])(?:(?:\d{4}[ \-]?){3}\d{4}|\d{4}[ \-]?\d{6}[ \-]?\d{5}|\d{13,19})(?!\d)",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[\-. ]\d{4}"
             r"|\d{3}[\-.]\d{3}[\-.]\d{4})(?![.\-]?\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "hash": r"(?<![\p{L}\p{N}])(?=[a-fA-F]{0,40}\d)[0-9a-fA-F]{32,64}(?![\p{L}\p{N}])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{TITLES['m']}|{TITLES['f']}|Dr)\.? {NAME}(?: {NAME})?",
}
ENTITY = "|".join(KINDS.values())
SECRET_VALUE = r"[A-Za-z0-9_\-./+]{6,128}$"

# Given names by script and gender ("n": either); surnames are put together from syllables.
GIVEN = {
    "latin_m": "Adam Bruno Carl Daniel Edgar Felix Gustav Henri Ivan Jonas Karim Louis Marco Nils Oscar Paul Ramon Simon Theo Victor",
    "latin_f": "Alma Berta Clara Diana Elena Flora Greta Helen Irene Julia Katrin Laura Marta Nora Olivia Paula Rosa Sofia Teresa Vera",
    "latin_n": "Alex Ariel Casey Dana Eden Jules Kim Lou Noa Robin Sacha Toni",
    "cyrillic_m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Степан Фёдор",
    "cyrillic_f": "Алла Вера Галина Дарья Елена Жанна Ирина Кира Лидия Мария Нина Ольга Полина Софья Юлия",
    "cyrillic_n": "Женя Саша Валя",
}
SYLLABLES = {
    "latin": ("B D F G H K L M N P R S T V W Br Dr Gr Kr Tr".split(), "a e i o u".split(),
              "l m n r s t ld nd rn st".split(), "a e o u".split(), "ber der feld ler man mer ner sen son ton vik wald".split()),
    "cyrillic": ("Б В Г Д З К Л М Н П Р С Т Ф Х".split(), "а е и о у".split(), "л м н р с т в к".split(), "а е о у".split(),
                 "ков лов нов ров тов шин лин нин рин мин".split()),
}
# What gives a composed name its gender.
ENDINGS = {
    "latin_m": "an en in on us ard rik mund win bert".split(), "latin_f": "a ia ina ela ara ise ette ika lind rid".split(),
    "latin_n": "y i o is el".split(), "cyrillic_m": "ан ен ин ор ил ей".split(), "cyrillic_f": "а ия ина ара ела".split(),
    "cyrillic_n": "и я о".split(),
}


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _stream(seed: Column, chars: Column) -> Column:
    """Array of numbers 0 to 255, one for each of ``chars`` characters and some more."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(chars / 32).cast("int") + 1), lambda j: F.sha2(F.concat_ws("|", seed, j.cast("string")), 256))
    return _let(F.array_join(blocks, ""), lambda h: F.transform(
        F.sequence(F.lit(1), chars + 32), lambda i: F.conv(F.substr(h, 2 * i - 1, F.lit(2)), 16, 10).cast("int")))


def _pick(options: str | list, number: Column) -> Column:
    values = F.array(*(F.lit(o) for o in options))
    return F.get(values, number % len(options))


def _like(text: Column, stream: Column, hexadecimal: bool = False) -> Column:
    """Each letter becomes a letter of its case, each digit a digit; all else stays."""
    low, up = ("abcdef", "ABCDEF") if hexadecimal else ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    def one(i):
        c, r = F.substr(text, i, F.lit(1)), F.get(stream, i - 1)
        return (F.when(c.rlike("[0-9]"), F.substr(F.lit("0123456789"), r % 10 + 1, F.lit(1)))
                .when(c.rlike(r"\p{Lu}"), F.substr(F.lit(up), r % len(up) + 1, F.lit(1)))
                .when(c.rlike(r"\p{L}"), F.substr(F.lit(low), r % len(low) + 1, F.lit(1))).otherwise(c))
    return F.when(F.length(text) == 0, text).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), one), ""))


def _lay_digits(surface: Column, digits: Column) -> Column:
    """The surface with its digits replaced one by one; more digits than it has follow at its end."""
    def one(i):
        c = F.substr(surface, i, F.lit(1))
        return F.when(c.rlike("[0-9]"), F.substr(digits, F.length(_digits(F.substr(surface, F.lit(1), i))), F.lit(1))).otherwise(c)
    rest = F.substr(digits, F.length(_digits(surface)) + 1, F.length(digits))
    return F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(surface)), one), ""), rest)


def _lay_case(surface: Column, text: Column) -> Column:
    """The text in the case of the surface, letter by letter."""
    def one(i):
        c = F.substr(text, i, F.lit(1))
        return F.when(F.substr(surface, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _name_parts(surface: Column) -> Column:
    """``(kind, canon, surface)`` of a person's given name and surname."""
    gender = (F.when(surface.rlike(rf"^(?:{TITLES['m']})\b"), "m").when(surface.rlike(rf"^(?:{TITLES['f']})\b"), "f").otherwise("n"))
    words = F.split(surface, " ")
    last = F.element_at(words, -1)
    woman = _script(last).eqNullSafe("cyrillic") & (gender == "f") & F.lower(last).endswith("а")
    stem = F.when(woman, F.substr(F.lower(last), F.lit(1), F.length(last) - 1)).otherwise(F.lower(last))
    surname = F.struct(F.concat(F.lit("surname_"), _script(last)).alias("kind"), stem.alias("canon"), last.alias("surface"))
    given = F.struct(F.concat(F.lit("given_"), _script(words[1]), F.lit("_"), gender).alias("kind"), F.lower(words[1]).alias("canon"),
                     words[1].alias("surface"))
    return F.when(F.size(words) > 2, F.array(given, surname)).otherwise(F.array(surname))


def _parts(surface: Column, check_digits: bool = False) -> Column:
    """What of a match is replaced: an array of ``(kind, canon, surface)``.  With ``check_digits``, digits that
    only look like a card number (no issuer's first digits, or a wrong check digit) are ``plain`` and stay."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        kind = F.when(surface.rlike(rf"\A(?:{pattern})\z"), name).otherwise(kind)
    value = F.regexp_extract(surface, SECRET_VALUE, 0)

    def simple(kind):
        digits = _digits(surface)
        code = F.when(surface.startswith("+"), F.regexp_extract(surface, r"^\+(\d{1,3}?)(?=[ .\-(])", 1)).otherwise(
            F.when(F.length(digits) == 10, "1").otherwise(""))
        canon = (F.when(kind.isin("card", "ssn"), digits)
                 .when(kind == "phone", F.concat(code, F.lit("/"), F.when(surface.startswith("+"), F.substr(
                     digits, F.length(code) + 1, F.length(digits))).otherwise(digits)))
                 .when(kind.isin("email", "hash"), F.lower(surface))
                 .when(kind == "iban", F.replace(surface, F.lit(" "), F.lit("")))
                 .when(kind == "secret", F.when(value.rlike("^[0-9a-fA-F]+$"), F.lower(value)).otherwise(value))
                 .otherwise(surface))
        return F.array(F.struct(kind.alias("kind"), canon.alias("canon"), F.when(kind == "secret", value).otherwise(surface).alias("surface")))
    if check_digits:
        real = _luhn(_digits(surface)) & _digits(surface).rlike("^([3-6]|2[2-7])")
        kind = F.when((kind == "card") & ~real, "plain").otherwise(kind)
    return _let(kind, lambda k: F.when(k == "person", _name_parts(surface)).otherwise(simple(k)))


def _surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical form's replacement, itself in canonical form."""
    def made(s):
        def number(i):
            return F.get(s, F.lit(i)) * 65536 + F.get(s, F.lit(i + 1)) * 256 + F.get(s, F.lit(i + 2))
        # characters beyond the format, once it is crowded
        more = F.greatest(attempt - (WIDEN - 1), F.lit(0))
        letters = F.array_join(F.transform(F.sequence(F.lit(1), more + 1), lambda j: F.substr(
            F.lit("abcdefghijklmnopqrstuvwxyz"), F.get(s, j % 32) % 26 + 1, F.lit(1))), "")
        numbers = F.array_join(F.transform(F.sequence(F.lit(1), more + 1), lambda j: (F.get(s, j % 32) % 10).cast("string")), "")
        tail = lambda chars: F.substr(chars, F.lit(1), more)
        syllables = lambda groups: F.array_join(F.transform(F.slice(F.sequence(F.lit(1), more + 1), F.lit(1), more), lambda j: F.concat(
            F.get(F.array(*map(F.lit, groups[2])), F.get(s, (7 * j) % 31) % len(groups[2])),
            F.get(F.array(*map(F.lit, groups[1])), F.get(s, (7 * j + 3) % 31) % len(groups[1])))), "")
        local, domain = F.split_part(canon, F.lit("@"), F.lit(1)), F.split_part(canon, F.lit("@"), F.lit(2))
        host = F.regexp_replace(domain, r"\.[^.]*$", "")
        email = F.concat(_like(local, s), tail(letters), F.lit("@"), _let(_stream(F.concat_ws("|", F.lit(key), F.lit("domain"), host), F.length(host)),
                                                           lambda d: _like(host, d)), F.regexp_extract(domain, r"\.[^.]*$", 0))
        first = F.split_part(canon, F.lit("."), F.lit(1))
        ipv4 = F.concat_ws(".", F.when(first.isin("10", "127") & (more == 0), first).otherwise((F.get(s, F.lit(0)) % 100 + 11).cast("string")),
                           *(F.get(s, F.lit(k)).cast("string") for k in (1, 2, 3)))
        digits = _like(canon, s)
        body = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2), F.length(canon) - 2))
        ends = F.filter(F.array(*(F.lit(str(d)) for d in range(10))), lambda d: _luhn(F.concat(body, d)) == _luhn(canon))
        card = F.concat(body, F.get(ends, F.get(s, F.lit(31)) % F.size(ends)))
        phone = F.concat(F.split_part(canon, F.lit("/"), F.lit(1)), F.lit("/"), _like(F.split_part(canon, F.lit("/"), F.lit(2)), s), tail(numbers))
        out = (F.when(kind == "email", email).when(kind == "ipv4", ipv4).when(kind == "card", card).when(kind == "phone", phone)
               .when((kind == "hash") | ((kind == "secret") & canon.rlike("^[0-9a-f]+$")), _like(canon, s, hexadecimal=True))
               .when(kind == "cloud_key", F.concat(F.substr(canon, F.lit(1), F.lit(4)), F.substr(digits, F.lit(5), F.length(canon))))
               .when(kind == "iban", F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.substr(digits, F.lit(3), F.length(canon)))))
        for name, options in GIVEN.items():
            groups = SYLLABLES[name.split("_")[0]]
            composed = F.concat(*(_pick(g, number(3 * k)) for k, g in enumerate(groups[:3])), _pick(groups[3], number(9)),
                                syllables(groups), _pick(groups[2], number(12)), _pick(ENDINGS[name], number(15)))
            out = out.when(kind == f"given_{name}", F.lower(F.when(attempt == 0, _pick(options.split(), number(0))).otherwise(composed)))
        for script, groups in SYLLABLES.items():
            name = [_pick(g, F.get(s, F.lit(3 * k)) + 256 * F.get(s, F.lit(3 * k + 1))) for k, g in enumerate(groups)]
            out = out.when(kind == f"surname_{script}", F.lower(F.concat(*name[:2], syllables(groups), *name[2:])))
        return out.otherwise(F.concat(digits, F.when(kind.isin("ssn", "secret"), tail(numbers)).otherwise("")))
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    return _let(_stream(seed, F.length(canon)), made)


def _render(kind: Column, surface: Column, canon: Column) -> Column:
    """The replacement in the surface's format."""
    digits = F.regexp_replace(canon, "[^0-9]", "")
    shown = F.when(surface.startswith("+") | (kind != "phone"), digits).otherwise(F.split_part(canon, F.lit("/"), F.lit(2)))
    name = F.when((F.length(surface) > 1) & (F.upper(surface) == surface), F.upper(canon)).otherwise(F.initcap(canon))
    woman = kind.eqNullSafe("surname_cyrillic") & F.lower(surface).endswith("а")
    return (F.when(kind.isin("phone", "card", "ssn"), _lay_digits(surface, shown))
            .when(kind.isin("email", "hash", "secret"), _lay_case(surface, canon))
            .when(kind == "iban", F.when(surface.contains(" "), F.rtrim(F.regexp_replace(canon, "(.{4})", "$1 "))).otherwise(canon))
            .when(kind.startswith("given_"), name)
            .when(kind.startswith("surname_"), F.concat(name, F.when(woman, "а").otherwise("")))
            .otherwise(canon))


def surrogates(entities: DataFrame, key: str = KEY, rounds: int = ROUNDS) -> DataFrame:
    """``(kind, canon, surrogate)`` of distinct ``(kind, canon)``: keyed, distinct, none of them real.

    In each round the smallest of the forms that share a replacement keeps it, if it is no real value
    and nobody has it from an earlier round; only the others go on.  From the fourth attempt on each
    adds a character to the format (a syllable to a name), so the values to choose from grow
    faster than the forms.  Names of all genders, scripts and of both sorts are one space."""
    name = F.col("kind").startswith("given_") | F.col("kind").startswith("surname_")
    todo = entities.withColumn("space", F.when(name, "name").otherwise(F.col("kind")))
    real = materialize(todo.select("space", F.col("canon").alias("surrogate")).distinct())
    settled = None
    for attempt in range(rounds):
        made = materialize(todo.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canon"), F.lit(attempt), key)))
        first = made.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "canon")).alias("winner"))
        good = (made.join(first, ["space", "surrogate"]).where(F.col("winner") == F.struct("kind", "canon"))
                .join(real, ["space", "surrogate"], "left_anti"))
        if settled is not None:
            good = good.join(settled, ["space", "surrogate"], "left_anti")
        good = materialize(good.select("kind", "canon", "space", "surrogate"))
        settled = good if settled is None else settled.unionByName(good)
        todo = made.join(good, ["kind", "canon"], "left_anti").drop("surrogate")
        if todo.isEmpty():
            return settled.select("kind", "canon", "surrogate")
    raise RuntimeError(f"replacements still collide after {rounds} rounds")


def surrogate_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY, count_col: str | None = None,
                  check_digits: bool = False) -> DataFrame:
    """The input rows and columns with the entities of ``text_col`` replaced.

    Rows without an entity, null and empty texts among them, are returned as they are; repeated
    rows and ids are replaced alike.  ``check_digits`` leaves numbers alone that only have a card's
    length.  ``count_col`` adds the number of replaced matches.  Extra
    columns keep their values, whatever their names."""
    prepare(docs.sparkSession)
    if text_col not in docs.columns:
        raise ValueError(f"no column {text_col}")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("r"))
    text = F.col(f"r.`{text_col}`")
    hint = text.rlike("[0-9@]") | text.rlike(KINDS["person"])       # every other kind has a digit or an at sign
    has = F.coalesce(hint & text.rlike(ENTITY), F.lit(False))
    clean, dirty = rows.where(~has), rows.where(has)
    # rows of equal id and text have equal entities; the id spreads the copies of a text
    dirty = dirty.withColumn("key", F.concat_ws(":", F.col(f"r.`{id_col}`").cast("string"), F.xxhash64(text).cast("string"), F.length(text).cast("string")))
    marks = dirty.select("key", F.posexplode(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).alias("place", "match")).distinct()
    marks = materialize(marks.select("key", "place", "match", F.posexplode(_parts(F.col("match"), check_digits)).alias("nth", "part")))
    marks = marks.select("*", F.struct("part.kind", "part.canon").alias("entity"), F.pmod(F.xxhash64("key"), F.lit(64)).alias("spread"))
    known = surrogates(marks.where("entity.kind <> 'plain'").select("entity.kind", "entity.canon").distinct(), key)
    table = known.select(F.struct("kind", "canon").alias("entity"), "surrogate")
    made = attach(marks, table, "entity", "spread").withColumn(
        "shown", F.when(F.col("part.kind") == "plain", F.col("part.surface")).otherwise(
            _render(F.col("part.kind"), F.col("part.surface"), F.col("surrogate"))))
    one = made.groupBy("key", "place", "match").agg(F.sort_array(F.collect_list(F.struct("nth", F.col("part.surface").alias("old"), F.col("shown").alias("new"),
                                                                                         F.col("part.kind").alias("kind")))).alias("parts"))
    # the parts stand at the end of the match, in their order, with single spaces between them
    size = F.aggregate("parts", F.lit(-1), lambda n, p: n + 1 + F.length(p["old"]))
    one = one.withColumn("new", F.concat(F.substr("match", F.lit(1), F.length("match") - size),
                                         F.array_join(F.transform("parts", lambda p: p["new"]), " ")))
    per_row = one.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "new", "parts"))).alias("found"))
    named = F.filter(F.flatten(F.transform("found", lambda x: x["parts"])), lambda p: p["kind"].startswith("surname_") | p["kind"].startswith("given_"))
    longest = F.array_sort(F.array_distinct(F.transform(named, lambda p: p["old"])), lambda a, b: F.length(b) - F.length(a))
    per_row = per_row.select("key", F.transform("found", lambda x: x["new"]).alias("new"),
                             F.size(F.filter("found", lambda x: x["parts"][0]["kind"] != "plain")).cast("bigint").alias("n"), named.alias("names"), F.when(F.size(named) > 0, F.concat(
        F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))).alias("pattern"))

    def renamed(between):
        """Names without a title, of people whom the document names with one: all in one pass over the
        original text, so no replacement is replaced.  Of equal names the document's first counts."""
        found = F.transform(F.regexp_extract_all(between, F.col("pattern"), F.lit(0)), lambda m: F.filter("names", lambda p: p["old"] == m)[0]["new"])
        return F.when(F.col("pattern").isNull(), between).otherwise(F.array_join(
            F.zip_with(F.split(between, F.col("pattern"), -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))
    between = F.transform(F.split(text, ENTITY, -1), renamed)
    later = F.array_join(F.zip_with(between, F.col("new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    done = dirty.join(per_row, "key")
    fields = [F.col(f"r.`{c}`").alias(c) if c != text_col else later.alias(c) for c in docs.columns]
    extra = ([F.col("n").alias(count_col)], [F.lit(0).cast("bigint").alias(count_col)]) if count_col else ([], [])
    return done.select(*fields, *extra[0]).union(clean.select(*(F.col(f"r.`{c}`").alias(c) for c in docs.columns), *extra[1]))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate_pii(documents(spark, sf_dir).select("doc_id", "text"), count_col="n_entities")
