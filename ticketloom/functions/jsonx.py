"""Strict JSON-object parsing and key access as Column expressions.

Python's ``json.loads`` is stricter than Spark's JSON reader in some ways
(no single quotes, no trailing text) and laxer in others (NaN, repeated
keys).  ``with_object`` reproduces it with two ``from_json`` calls and no
UDF: the text is wrapped once in ``[...]`` and once in ``{"r": ...}``; a
text is accepted only when both wrappers parse to exactly one object.
Values stay ``VARIANT`` so key absence, JSON null and the JSON type of a
value remain distinguishable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJ_TYPE = "map<string,variant>"
_STRICT = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "false",
           "allowNumericLeadingZeros": "false", "allowNonNumericNumbers": "true",
           "allowBackslashEscapingAnyCharacter": "false", "allowComments": "false",
           "allowUnquotedFieldNames": "false"}
_CORRUPT = "_corrupt"
VARIANT_DUPLICATES = "spark.sql.variant.allowDuplicateKeys"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dedup_last(m: Column) -> Column:
    """Repeated keys: first position, last value (what a Python dict keeps)."""
    entries = F.map_entries(m)
    first_only = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, F.lit(1), i), lambda x: x["key"] == e["key"]))
    fixed = F.transform(
        first_only,
        lambda e: F.struct(
            e["key"].alias("key"),
            F.element_at(F.filter(entries, lambda x: x["key"] == e["key"]), -1)["value"].alias("value")))
    return F.when(F.size(F.array_distinct(F.map_keys(m))) == F.size(m), m).otherwise(
        F.map_from_entries(fixed))


def materialize(df: DataFrame, **cols: Column) -> DataFrame:
    """Adds ``cols`` as outputs of a one-row generator.  Downstream
    expressions then read plain attributes: the optimizer cannot inline an
    expensive expression (a JSON parse) into each of its many uses."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def with_object(df: DataFrame, text, out: str = "obj", only_valid: bool = False) -> DataFrame:
    """Adds ``out`` = map<string,variant> of the JSON text when it is a JSON
    object (null otherwise; or drops those rows when ``only_valid``).

    The two wrapper parses run once per row (generator outputs); the
    acceptance test and the repeated-key fix-up read those attributes.
    Nested values are VARIANT; a repeated key inside a nested object is
    accepted with its last value, as Python does, which needs
    ``spark.sql.variant.allowDuplicateKeys`` (``session.ensure_settings``)."""
    if df.sparkSession.conf.get(VARIANT_DUPLICATES, "false") != "true":
        raise RuntimeError(f"strict JSON needs {VARIANT_DUPLICATES}=true: call ticketloom.session.ensure_settings")
    t = _col(text)
    d = materialize(
        df,
        _ja=F.from_json(F.concat(F.lit("["), t, F.lit("]")), f"array<{OBJ_TYPE}>", _STRICT),
        _jw=F.from_json(F.concat(F.lit('{"r":'), t, F.lit("}")),
                        f"r {OBJ_TYPE}, {_CORRUPT} string",
                        {**_STRICT, "columnNameOfCorruptRecord": _CORRUPT}),
        _jn=t.isNotNull())
    first = F.get(F.col("_ja"), 0)
    ok = ((F.size("_ja") == 1) & first.isNotNull() & F.col("_jw.r").isNotNull()
          & F.col(f"_jw.{_CORRUPT}").isNull() & F.col("_jn"))
    obj = F.when(F.coalesce(ok, F.lit(False)), _dedup_last(first))
    if only_valid:
        d = d.select("*", F.explode(F.array_compact(F.array(obj))).alias(out))
    else:
        d = materialize(d, **{out: obj})
    return d.drop("_ja", "_jw", "_jn")


def with_nested_object(df: DataFrame, m: str, key: str, out: str) -> DataFrame:
    """Adds ``out`` = the object stored under ``key`` of map ``m`` as a map
    (null when absent or not an object), materialized once."""
    return materialize(df, **{out: F.try_variant_get(value(m, key), "$", OBJ_TYPE)})


def has_key(m, key: str) -> Column:
    """``key in d``: true for null-valued keys too; false for a null object."""
    return F.coalesce(F.map_contains_key(_col(m), F.lit(key)), F.lit(False))


def value(m, key: str) -> Column:
    """The VARIANT stored under ``key`` (SQL null when absent)."""
    return F.try_element_at(_col(m), F.lit(key))


def json_type(v) -> Column:
    """'STRING', 'VOID' (JSON null), 'BIGINT', 'DOUBLE', 'OBJECT<...>', ..."""
    return F.schema_of_variant(_col(v))


def as_string(v) -> Column:
    """The string when the value is a JSON string, else null."""
    v = _col(v)
    return F.when(json_type(v) == "STRING", v.cast("string"))


def as_text(v) -> Column:
    """Any non-null JSON value as text (strings unquoted, objects as JSON)."""
    return _col(v).cast("string")


def json_text(v) -> Column:
    """Canonical JSON text of the value; SQL null for absent or JSON null."""
    return F.nullif(F.to_json(_col(v)), F.lit("null"))


def member_text(text, key: str) -> Column:
    """JSON text of the member ``key`` of an object's text, with its members in
    their order (strings come without quotes); of repeated keys the last."""
    members = F.get(F.from_json(F.concat(F.lit("["), _col(text), F.lit("]")), "array<map<string,string>>", _STRICT), 0)
    return F.try_element_at(F.filter(F.map_entries(members), lambda e: e["key"] == key), F.lit(-1))["value"]


def present_non_null(m, key: str) -> Column:
    """Key present with a non-null value (pandas' not-NaN)."""
    v = value(m, key)
    return v.isNotNull() & (json_type(v) != "VOID")


def get_or(m, key: str, default) -> Column:
    """``d.get(key, default)`` as text: default only when the key is absent;
    a JSON null stays null."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.when(has_key(m, key), as_text(value(m, key))).otherwise(d)


def quote(c) -> Column:
    """JSON string literal of a text column (escaping by the JSON writer)."""
    s = F.to_json(F.create_map(F.lit("k"), _col(c)), {"ignoreNullFields": "false"})
    # '{"k":' + quoted + '}'
    return F.when(_col(c).isNotNull(), s.substr(F.lit(6), F.length(s) - 6)).otherwise(F.lit("null"))


# -- the bytes of Python's json.dumps -------------------------------------------

# a JSON text's tokens: strings, brackets and separators, other literals
_TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},:]|[^\s\[\]{},:"]++'
# what needs no escape, an escape, any other character
_RUN = r"(?s)[ !#-\[\]-~]++|\\u[0-9a-fA-F]{4}|\\.|."
_PLAIN_RUN = r"(?s)[ !#-\[\]-~]++|."
_SHORT = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r", 34: '"', 92: "\\"}


def _escaped(code: Column) -> Column:
    """A code point as ``json.dumps`` writes it in a string: itself in ASCII from space to ``~``, else an
    escape, above U+FFFF as a surrogate pair."""
    unit = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))
    over = code - 0x10000
    out = (F.when(code.between(32, 126), F.chr(code)).when(code < 0x10000, unit(code))
           .otherwise(F.concat(unit(F.shiftright(over, 10) + 0xD800), unit(over.bitwiseAND(0x3FF) + 0xDC00))))
    for n, letter in _SHORT.items():
        out = F.when(code == n, F.lit("\\" + letter)).otherwise(out)
    return out


def py_quote(c) -> Column:
    """``json.dumps`` of a text column, byte for byte (``null`` for a null)."""
    c = _col(c)
    run = lambda r: F.when((F.length(r) > 1) | r.rlike(r"^[ !#-\[\]-~]"), r).otherwise(_escaped(F.ascii(r)))
    inner = F.when(c.rlike(r"^[ !#-\[\]-~]*+\z"), c).otherwise(
        F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PLAIN_RUN), F.lit(0)), run), ""))
    return F.when(c.isNotNull(), F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(F.lit("null"))


def _requoted(token: Column) -> Column:
    """A JSON string literal with the escapes that ``json.dumps`` uses."""
    code = lambda hexes: F.conv(hexes, 16, 10).cast("int")
    back = F.create_map(*[F.lit(x) for n, letter in {**_SHORT, 47: "/"}.items() for x in (letter, n)])
    run = lambda r: (F.when(F.startswith(r, F.lit("\\u")), _escaped(code(F.substring(r, 3, 4))))
                     .when(F.startswith(r, F.lit("\\")), _escaped(F.element_at(back, F.substring(r, 2, 1))))
                     .when((F.length(r) > 1) | r.rlike(r"^[ !#-\[\]-~]"), r).otherwise(_escaped(F.ascii(r))))
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    return F.when(token.rlike(r'^"[ !#-\[\]-~]*+"\z'), token).otherwise(
        F.concat(F.lit('"'), F.array_join(F.transform(F.regexp_extract_all(inner, F.lit(_RUN), F.lit(0)), run), ""), F.lit('"')))


def _float_repr(x: Column) -> Column:
    """``repr`` of a double: the digits of Spark's text, with a point where Python puts it.  (Java 17 writes
    the very smallest doubles with a digit more than needed.)"""
    s = F.abs(x).cast("string")
    mantissa, power = F.substring_index(s, "E", 1), F.coalesce(F.try_element_at(F.split(s, "E"), F.lit(2)).cast("int"), F.lit(0))
    whole, part = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    every = F.concat(whole, part)
    digits = F.rtrim(F.ltrim(every, F.lit("0")), F.lit("0"))
    point = F.length(whole) + power - (F.length(every) - F.length(F.ltrim(every, F.lit("0"))))
    n, e = F.length(digits), F.abs(point - 1).cast("string")
    zeros = lambda k: F.repeat(F.lit("0"), F.greatest(k, F.lit(0)))
    fixed = (F.when(point <= 0, F.concat(F.lit("0."), zeros(-point), digits))
             .when(point >= n, F.concat(digits, zeros(point - n), F.lit(".0")))
             .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n))))
    science = F.concat(F.substring(digits, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise(F.lit("")),
                       F.lit("e"), F.when(point < 1, F.lit("-")).otherwise(F.lit("+")), F.lpad(e, F.greatest(F.length(e), F.lit(2)), F.lit("0")))
    sign = F.when(F.startswith(x.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    body = (F.when(s == "Infinity", F.lit("Infinity")).when(digits == "", F.lit("0.0"))
            .when((point > -4) & (point <= 16), fixed).otherwise(science))
    return F.concat(sign, body)


def _literal(token: Column) -> Column:
    """A number or word as ``json.dumps`` writes it."""
    return (F.when(token.rlike(r"^-?[0-9]+\z"), F.when(token == "-0", F.lit("0")).otherwise(token))
            .when(token.rlike(r"^-?[0-9]"), _float_repr(token.cast("double"))).otherwise(token))


def py_dumps(text, indent: int = 2, level: int = 0) -> Column:
    """``json.dumps(json.loads(text), indent=indent)``, byte for byte, of valid JSON text, as it stands
    ``level`` levels deep (its first line has no margin).  Members keep their order; a key that an
    object repeats is written as often.  One fold over the text's tokens."""
    margin = lambda depth: F.concat(F.lit("\n"), F.repeat(F.lit(" "), depth * indent))

    def step(acc, t):
        opens, closes = t.isin("{", "["), t.isin("}", "]")
        fresh = acc["last"].isin("{", "[")
        depth = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        lead = (F.when(fresh & ~closes, margin(acc["depth"])).when(closes & ~fresh, margin(depth)).otherwise(F.lit("")))
        said = (F.when(t == ",", F.concat(t, margin(depth))).when(t == ":", F.lit(": ")).when(opens | closes, t)
                .when(F.startswith(t, F.lit('"')), _requoted(t)).otherwise(_literal(t)))
        return F.struct(F.concat(acc["out"], lead, said).alias("out"), depth.cast("int").alias("depth"), t.alias("last"))
    start = F.struct(F.lit("").alias("out"), F.lit(level).cast("int").alias("depth"), F.lit("").alias("last"))
    return F.aggregate(F.regexp_extract_all(_col(text), F.lit(_TOKEN), F.lit(0)), start, step, lambda acc: acc["out"])
