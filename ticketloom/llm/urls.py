"""URL filtering: a rule list first, association rules for what it leaves open.

Spark's FP-growth mines which combinations of URL tokens go with a verdict in labelled URLs.  Rules
under a support or a confidence are dropped, and those that a shorter rule makes idle; the rest
match through an inverted index on each rule's rarest token."""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import attach, documents, materialize, prepare

#: (verdict, host, path): fixed by the contract of the query.
RULE_LIST = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE = 0.01, 5, 0.95
BROADCAST_RULES = 20_000        # more rules than this are joined by shuffle, SALTS times
SALTS = 16
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
RULES = "rule_id bigint, antecedent array<array<string>>, key array<string>, size int, verdict string, confidence double, support bigint"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, SPLIT, 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def list_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """``struct(size, host_size, rule, verdict)`` of the longest rule that fits, or null: the host is the rule's
    or under it, and the path starts with the rule's.  Of equally long rules, that of the longer host wins."""
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(len(h)).alias("host_size"),
                            F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))) for verdict, h, p in rules]
    return fits[0] if len(fits) == 1 else F.greatest(*fits)


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: ``s:`` scheme, ``h1:``, ``h2:``, ... host labels from the right, ``w:`` the words of
    labels with hyphens, ``p:`` path segments in lower case with digit runs as 0, ``q:`` names of the query.
    A null URL has none."""
    host, path = host_of(url), path_of(url)
    labels = F.reverse(F.split(host, r"\."))
    hyphened = F.filter(labels, lambda x: F.contains(x, F.lit("-")))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    tag = lambda mark, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    places = F.filter(F.transform(labels, lambda x, k: F.concat(F.lit("h"), (k + 1).cast("string"), F.lit(":"), x)),
                      lambda x: ~F.endswith(x, F.lit(":")))
    return F.coalesce(F.sort_array(F.array_distinct(F.concat(
        tag("s:", F.array(F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))), places,
        tag("w:", F.flatten(F.transform(hyphened, lambda x: F.split(x, "-")))),
        tag("p:", F.split(F.regexp_replace(F.lower(path), "[0-9]+", "0"), "/")),
        tag("q:", F.transform(F.split(query, "[&;]"), lambda x: F.substring_index(x, "=", 1)))))),
        F.array().cast("array<string>"))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_rows: int = MIN_ROWS,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``RULES`` of ``(tokens array<string>, verdict string)`` rows: every token combination that, with a verdict,
    is in at least ``min_support`` of the rows and ``min_rows``, and whose rows have that verdict in
    ``min_confidence`` of all cases.

    Tokens that all rows hold tell nothing and are left out; tokens that always occur together are
    one item (``antecedent`` lists the tokens of each, any of which stands for it), so that a URL held by
    a third of all rows adds one item and not its tokens' power set.  A rule goes if one with fewer
    items and the same verdict is as confident: it matches wherever the longer one does.  Frequent
    tokens reach the driver; they are at most the mean number of tokens divided by ``min_support``,
    however many rows there are.  Rows without a verdict are left out; no rows give no rules."""
    spark = labelled.sparkSession
    rows = materialize(labelled.where(F.col("verdict").isNotNull()).select("tokens", "verdict"))
    n = rows.count()
    least = max(math.ceil(min_support * n), min_rows)
    empty = spark.createDataFrame([], RULES)
    if n < least:
        return empty
    mark = lambda seed: F.sum(F.xxhash64(F.lit(seed), "tokens").cast("decimal(20,0)"))
    items = (rows.select("tokens", F.explode("tokens").alias("token")).groupBy("token")
             .agg(F.count("*").alias("n"), mark(1).alias("a"), mark(2).alias("b"))
             .where(F.col("n").between(least, n - 1)).groupBy("n", "a", "b")
             .agg(F.sort_array(F.collect_set("token")).alias("members")).select("members", "n").collect())
    if not items:
        return empty
    items = {r.members[0]: (r.members, r.n) for r in items}
    verdict = F.concat(F.lit("="), F.col("verdict"))         # no token starts so
    baskets = rows.select(F.concat(F.filter("tokens", lambda t: t.isin(list(items))), F.array(verdict)).alias("items"))
    # half a row less than the number needed, so that rounding cannot ask for more
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(baskets)
    found = (model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit("=")))
             .where(~F.exists("antecedent", lambda x: F.startswith(x, F.lit("="))))
             .select(F.sort_array("antecedent").alias("items"), F.substring(F.col("consequent")[0], 2, 1 << 30).alias("verdict"), "confidence",
                     F.round(F.col("support") * n).cast("bigint").alias("support")))
    known = F.broadcast(spark.createDataFrame([(k, m, c) for k, (m, c) in items.items()], "item string, members array<string>, n bigint"))
    found = (found.withColumn("rule_id", F.xxhash64("items", "verdict")).select("*", F.explode("items").alias("item")).join(known, "item")
             .groupBy("rule_id", "verdict", "confidence", "support")
             .agg(F.sort_array(F.collect_list("members")).alias("antecedent"),
                  F.min_by("members", F.struct("n", "item")).alias("key"), F.count("*").cast("int").alias("size")))
    rules = materialize(found.select("rule_id", "antecedent", "key", "size", "verdict", "confidence", "support"))
    longer = rules.select(F.col("rule_id").alias("id"), F.flatten("antecedent").alias("tokens"), F.col("size").alias("long"),
                          F.col("verdict").alias("says"), F.col("confidence").alias("sure"))
    idle = matches(longer, rules, "id").where("size < long AND verdict = says AND confidence >= sure").select(F.col("id").alias("rule_id")).distinct()
    return materialize(rules.join(idle, "rule_id", "left_anti"))


def matches(sets: DataFrame, rules: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``sets`` (``id_col`` and ``tokens array<string>``, one row a set) with each rule that they hold.

    Rules are looked up by their rarest item and then checked whole.  They are broadcast only if there are
    at most ``BROADCAST_RULES``, else they are joined by token and salt."""
    posts = rules.withColumn("token", F.explode("key"))
    probes = sets.withColumn("token", F.explode("tokens"))
    if rules.count() <= BROADCAST_RULES:
        both = probes.join(F.broadcast(posts), "token")
    else:
        both = (probes.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
                .join(posts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))), ["token", "salt"]).drop("salt"))
    return (both.where(F.forall("antecedent", lambda m: F.arrays_overlap(m, F.col("tokens")))).drop("token")
            .dropDuplicates([id_col, "rule_id"]))


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULE_LIST,
               id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict, confidence, because)`` of every row of ``pages``.

    ``rule`` is the longest list rule that fits, as host and path, and gives the verdict; ``confidence`` and
    ``because`` are null.  Else the most confident mined rule that the URL's tokens hold does, of equals the
    one with more support, then allow before block; ``because`` is its antecedent, the tokens of one item
    joined by ``|``.  Else the verdict is ``default``.  Rules are mined from ``labelled``
    (``url``, ``verdict``; without it, from the pages that the list decides).

    A null URL, and one without ``://``, has an empty host and path; no list rule fits it.  Rows that repeat an
    id or a URL stay, URLs are read whole, and extra columns are ignored.  Each distinct token set is
    matched once, and rows fetch its answer by salted keys."""
    prepare(pages.sparkSession)
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("listed", list_rule(F.col("host"), F.col("path"), rules))
    taught = (labelled.select(url_tokens(F.col("url").cast("string")).alias("tokens"), "verdict") if labelled is not None else
              rows.where("listed IS NOT NULL").select(url_tokens(F.col("url")).alias("tokens"), F.col("listed.verdict").alias("verdict")))
    mined = mine_rules(taught)
    rows = rows.withColumn("tokens", F.when(F.col("listed").isNull(), url_tokens(F.col("url"))))
    rows = rows.withColumn("tokens_key", F.sha2(F.to_json("tokens"), 256)).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(64)))
    sets = rows.where("listed IS NULL").groupBy("tokens_key").agg(F.any_value("tokens").alias("tokens"))
    best = (matches(sets, mined, "tokens_key").groupBy("tokens_key")
            .agg(F.max(F.struct("confidence", "support", (F.col("verdict") == "allow").alias("mild"), "verdict", (-F.col("size")).alias("short"),
                                F.transform("antecedent", lambda m: F.array_join(m, "|")).alias("because"))).alias("best")))
    out = attach(rows.drop("tokens", "url"), best, "tokens_key", "salt")
    return out.select("page_id", "host", "path", F.col("listed.rule").alias("rule"),
                      F.coalesce("listed.verdict", "best.verdict", F.lit(default)).alias("verdict"),
                      F.col("best.confidence").alias("confidence"), F.col("best.because").alias("because"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every URL of ``pages`` by the fixed list, and where it is silent by rules mined from the URLs that
    it decides."""
    return judge_urls(documents(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


#: The same rules by brute force: every subset of a labelled URL's frequent tokens is counted.
ORACLE = f"""
WITH parts AS (
  SELECT page_id, url, row_number() OVER () AS place,
         coalesce(translate(regexp_extract(url, '{SPLIT}', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '') AS host,
         coalesce(regexp_extract(url, '{SPLIT}', 2), '') AS path FROM pages),
listed AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parts),
tokens AS (
  SELECT place, unnest(list_distinct(list_concat(list_concat(list_concat(
    list_transform(list_filter([lower(regexp_extract(url, '(?s)^(.*?)://', 1))], lambda x: x <> ''), lambda x: 's:' || x),
    list_filter(list_transform(list_reverse(string_split(host, '.')), lambda x, k: 'h' || k || ':' || x), lambda x: NOT suffix(x, ':'))),
    list_transform(list_filter(flatten(list_transform(list_filter(string_split(host, '.'), lambda x: contains(x, '-')),
                                                      lambda x: string_split(x, '-'))), lambda x: x <> ''), lambda x: 'w:' || x)),
    list_concat(
    list_transform(list_filter(string_split(regexp_replace(lower(path), '[0-9]+', '0', 'g'), '/'), lambda x: x <> ''), lambda x: 'p:' || x),
    list_transform(list_filter(list_transform(string_split_regex(regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1), '[&;]'),
                                              lambda x: split_part(x, '=', 1)), lambda x: x <> ''), lambda x: 'q:' || x))))) AS token
  FROM parts WHERE url IS NOT NULL),
taught AS (SELECT place, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS says FROM listed WHERE rule IS NOT NULL),
total AS (SELECT count(*) AS n, greatest(ceil({MIN_SUPPORT} * count(*)), {MIN_ROWS}) AS least FROM taught),
frequent AS (
  SELECT token FROM tokens JOIN taught USING (place) GROUP BY token
  HAVING count(*) >= (SELECT least FROM total) AND count(*) < (SELECT n FROM total)),
kept AS (SELECT place, list(token ORDER BY token) AS ts FROM tokens SEMI JOIN frequent USING (token) GROUP BY place),
subsets AS (
  SELECT place, list_filter(ts, lambda t, k: (mask >> (k - 1)) & 1 = 1) AS part
  FROM (SELECT place, ts, unnest(range(1, 1 << len(ts))) AS mask FROM kept)),
rules AS (
  SELECT part, verdict, hits / whole AS confidence, hits FROM (
    SELECT part, verdict, count(*) FILTER (says = verdict) AS hits, count(*) AS whole
    FROM subsets JOIN taught USING (place), (VALUES ('allow'), ('block')) v(verdict) GROUP BY part, verdict)
  WHERE hits >= (SELECT least FROM total) AND hits / whole >= {MIN_CONFIDENCE}),
best AS (SELECT place, max({{'c': confidence, 'h': hits, 'm': verdict = 'allow'}}) AS b FROM subsets JOIN rules USING (part) GROUP BY place)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN b IS NULL OR b.m THEN 'allow' ELSE 'block' END AS verdict
FROM listed LEFT JOIN best USING (place)"""
