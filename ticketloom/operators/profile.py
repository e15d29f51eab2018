"""Data-quality profile.

Distributions use one GROUPING SETS aggregate over a single scan, with
partial aggregation before the shuffle, so a value holding a third of the
rows costs no more than any other.  Duplicate detection groups by a
SHA-256 digest of the text (32 bytes shuffled instead of the whole text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.fixed_values import (
    HISTOGRAM_BINS, SEVERITY_DEFAULT, SEVERITY_MAPPING, SHORT_INPUT_CHARS, STANDARD_TYPES,
    TICKET_TYPE_DEFAULT, TICKET_TYPE_MAPPING, TOP_DEPARTMENTS)
from ticketloom.functions import jsonx


def _pct(n: Column, total) -> Column:
    t = total if isinstance(total, Column) else F.lit(total)
    return F.when(t > 0, F.round(F.lit(100.0) * n / t, 6))


def dataset_overview(raw: DataFrame) -> DataFrame:
    """A1: row count and the column list of the scanned frame."""
    cols = [c for c in raw.columns if c != "row_index"]
    return raw.agg(F.count("*").alias("total_records")).select(
        "total_records", F.lit(len(cols)).cast("bigint").alias("n_columns"),
        F.lit(", ".join(cols)).alias("columns"))


def raw_distributions(parsed: DataFrame, cols=("ticket_type", "severity",
                                               "department_impacted", "service_impacted")) -> DataFrame:
    """A2: value_counts of several columns from one scan (GROUPING SETS);
    nulls dropped.  Long form (column, value, n, rank)."""
    sets = [[c] for c in cols]
    k = len(cols)
    g = parsed.groupingSets(sets, *cols).agg(F.count("*").alias("n"), F.grouping_id().alias("_gid"))
    gid_of = {c: (2 ** k - 1) - 2 ** (k - 1 - i) for i, c in enumerate(cols)}
    g = g.select(
        F.coalesce(*[F.when(F.col("_gid") == gid_of[c], F.lit(c)) for c in cols]).alias("column"),
        F.coalesce(*[F.when(F.col("_gid") == gid_of[c], F.col(c)) for c in cols]).alias("value"), "n")
    return g.where(F.col("value").isNotNull())


def distribution(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """A3/T5: value, n, pct of all rows (nulls dropped from the values, kept
    in the total).  The total is a one-row sum over the grouped counts; the
    top-k is taken before it, so no task gets a row per distinct value."""
    g = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n")).scalar()
    g = g.where(F.col("value").isNotNull())
    if top is not None:
        g = g.orderBy(F.desc("n"), F.asc("value")).limit(top)
    return g.select("value", "n", _pct(F.col("n"), total).alias("pct"))


def quality_summary(clean: DataFrame, approximate: bool = False) -> DataFrame:
    """A4: rows, distinct types, distinct severities (nulls excluded).
    ``approximate`` uses HyperLogLog++ (approx_count_distinct) instead of an
    exact distinct, for columns with very many values."""
    distinct = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.countDistinct(c))
    return clean.agg(F.count("*").alias("total_records"),
                     distinct("ticket_type").alias("unique_ticket_types"),
                     distinct("severity").alias("unique_severities"))


_ROWS = "\u0000rows"


def key_entries() -> Column:
    """What ``missing_counts`` needs of a row: per key of the object whether
    it survives as non-null in the cleaned frame (type and severity are
    always filled, communication keeps only strings, other keys any non-null
    JSON value) and its position, plus two sentinel entries with the row
    count and the input's nullness, so no second pass counts rows."""
    def nn(e):
        k, v = e["key"], e["value"]
        return (F.when(k.isin("Ticket Type", "Severity"), F.lit(True))
                .when(k == "Preferred Communication", jsonx.json_type(v) == "STRING")
                .otherwise(jsonx.json_type(v) != "VOID"))
    entries = F.transform(F.map_entries("obj"), lambda e, i: F.struct(
        e["key"].alias("k"), nn(e).alias("nn"), i.alias("p")))
    sentinels = F.array(F.struct(F.lit(_ROWS).alias("k"), F.lit(True).alias("nn"), F.lit(0).alias("p")),
                        F.struct(F.lit("original_input").alias("k"),
                                 F.col("original_input").isNotNull().alias("nn"),
                                 F.size("obj").alias("p")))
    return F.concat(entries, sentinels)


def missing_counts(clean: DataFrame, entries: Column | None = None) -> DataFrame:
    """(column, n_missing, total, first_row, first_pos) for every key seen in
    any object plus original_input, from one explode + partial aggregation.
    ``first_row, first_pos`` sort the columns as pandas does: keys by first
    appearance (row, then position in the object), original_input right
    after the first row's keys.  Keys are open-ended: nothing here puts them
    all in one task."""
    e = clean.select("row_index", F.explode(key_entries() if entries is None else entries).alias("e"))
    per = e.groupBy(F.col("e.k").alias("column")).agg(
        F.count_if("e.nn").alias("non_null"),
        F.min(F.struct(F.col("row_index").alias("r"), F.col("e.p").alias("p"))).alias("_first"))
    total = per.where(F.col("column") == _ROWS).agg(F.max("non_null")).scalar()
    per = per.where(F.col("column") != _ROWS).withColumn("total", total)
    return per.select("column", (F.col("total") - F.col("non_null")).alias("n_missing"), "total",
                      F.col("_first.r").alias("first_row"), F.col("_first.p").cast("bigint").alias("first_pos"))


def missing_values(clean: DataFrame) -> DataFrame:
    """A5: count and percent of missing cells per column, only > 0, with
    the column's position in the frame."""
    m = missing_counts(clean)
    return (m.where(F.col("n_missing") > 0)
            .select("column", "first_row", "first_pos", "n_missing", _pct(F.col("n_missing"), F.col("total")).alias("pct")))


def length_stats(df: DataFrame, col: str = "original_input", approximate: bool = False) -> DataFrame:
    """Mean, median (interpolated), min, max, sample std of str.len().
    The exact ``median`` keeps a (value -> count) map per task, bounded by
    the number of distinct lengths, so it combines map-side; ``approximate``
    switches to percentile_approx (a fixed-size sketch)."""
    n = F.length(col)
    med = F.percentile_approx(n, 0.5, 10000).cast("double") if approximate else F.median(n)
    return df.agg(F.round(F.avg(n), 6).alias("mean"), F.round(med, 6).alias("median"),
                  F.min(n).cast("bigint").alias("min"), F.max(n).cast("bigint").alias("max"),
                  F.round(F.stddev_samp(n), 6).alias("std"))


def text_digest(col: str) -> Column:
    """Grouping key standing for the text (null stays null)."""
    return F.sha2(F.col(col), 256)


def duplicate_count(df: DataFrame, col: str = "original_input") -> DataFrame:
    """Rows after the first of each value (null is a value)."""
    g = df.groupBy(text_digest(col).alias("h")).agg(F.count("*").alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


DUPLICATE_SALTS = 64


def duplicate_rows(df: DataFrame, col: str = "original_input", id_col: str = "row_index",
                   salts: int = DUPLICATE_SALTS) -> DataFrame:
    """``duplicated()`` per row (keep first), salted against hot values.

    Each row gets a salt from a hash of its id.  The minimum id is taken per
    (digest, salt), then per digest over those at most ``salts`` partial
    minima, and joined back on (digest, salt).  A value held by a third of
    all rows is thus spread over ``salts`` join keys and tasks instead of
    one; no table is replicated, and no window runs over the text."""
    # null is a value here (as in pandas): '' can never be a SHA-256 hex digest
    rows = df.select(id_col, F.coalesce(text_digest(col), F.lit("")).alias("h"),
                     F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias("_s"))
    per_salt = rows.groupBy("h", "_s").agg(F.min(id_col).alias("_m"))
    per_value = per_salt.groupBy("h").agg(F.min("_m").alias("_first"))
    keys = per_salt.join(per_value, "h").select("h", "_s", "_first")
    j = rows.join(keys, ["h", "_s"])
    return j.select(id_col, (F.col(id_col) != F.col("_first")).alias("is_duplicate"))


def length_histogram(df: DataFrame, col: str = "original_input", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Numpy.histogram(lengths, bins=50): equal-width bins over
    [min, max], last bin closed, every bin listed (zeros kept).  Edges are
    ``lo + i * step`` as numpy builds them; indices are corrected against
    the edges exactly as numpy does."""
    by_length = (df.select(F.length(col).cast("double").alias("_x")).where("_x IS NOT NULL")
                 .groupBy("_x").agg(F.count("*").alias("_c")).checkpoint(eager=True))     # one row per length
    lo_hi = by_length.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")).first()
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin bigint, lo double, hi double, n bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    x = F.col("_x")
    b0 = F.floor((x - F.lit(lo)) * F.lit(bins / (hi - lo))).cast("bigint")
    b0 = F.least(F.greatest(b0, F.lit(0)), F.lit(bins - 1))
    edge = lambda b: F.when(b == bins, F.lit(hi)).otherwise(b.cast("double") * F.lit(step) + F.lit(lo))
    b1 = F.when(x < edge(b0), b0 - 1).otherwise(b0)
    b2 = F.when((b1 != bins - 1) & (x >= edge(b1 + 1)), b1 + 1).otherwise(b1)
    counts = by_length.groupBy(b2.alias("bin")).agg(F.sum("_c").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    out = grid.join(F.broadcast(counts), "bin", "left")
    b = F.col("bin")
    return out.select(b, edge(b).alias("lo"), edge(b + 1).alias("hi"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def _section(name: str, rows: DataFrame, ord1, key, n=None, pct=None, value=None, ord2=None) -> DataFrame:
    null = F.lit(None)
    return rows.select(
        F.lit(name).alias("section"), ord1.cast("bigint").alias("ord"),
        (F.lit(0) if ord2 is None else ord2).cast("bigint").alias("ord2"), key.alias("key"),
        (null if n is None else n).cast("bigint").alias("n"), (null if pct is None else pct).cast("double").alias("pct"),
        (null if value is None else value).cast("double").alias("value"))


def quality_report(clean: DataFrame) -> DataFrame:
    """K3: the data-quality report as a long table (section, ord, ord2, key,
    n, pct, value), rows of a section sorted by (ord, ord2); text is rendered
    from it.

    The cleaned rows are reduced once to a narrow table in the shared
    checkpoint folder (lengths, 32-byte text digests, key entries, three
    label columns); the sections are lazy aggregates over it.  Types and
    severities are bounded by their canonical values, departments by the
    top-k; keys may be any number and stay distributed."""
    base = clean.select(
        "row_index", "ticket_type", "severity", "department_impacted", key_entries().alias("entries"),
        F.length("original_input").alias("_len"), text_digest("original_input").alias("_h")).checkpoint(eager=True)
    ln = F.col("_len")
    s = base.agg(
        F.count("*").alias("total"), F.countDistinct("ticket_type").alias("types"), F.countDistinct("severity").alias("severities"),
        F.avg(ln).alias("mean"), F.median(ln).alias("median"), F.min(ln).alias("min"), F.max(ln).alias("max"),
        F.stddev_samp(ln).alias("std"), F.count_if(ln < SHORT_INPUT_CHARS).alias("short"),
        F.count_if(~F.coalesce(F.col("ticket_type").isin(STANDARD_TYPES), F.lit(False))).alias("nonstd"))
    dup = (base.groupBy("_h").agg(F.count("*").alias("n"))
           .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dup")))

    def lines(row: DataFrame, pairs) -> DataFrame:
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("o"), F.lit(k).alias("k"), F.col(c).cast("double").alias("v")) for i, k, c in pairs])).alias("x")).select("x.*")

    overview = lines(s, [(1, "Total Records", "total"), (2, "Unique Ticket Types", "types"), (3, "Unique Severities", "severities")])
    lengths = lines(s, [(i, k, c) for i, (k, c) in enumerate(
        [("Mean", "mean"), ("Median", "median"), ("Min", "min"), ("Max", "max"), ("Std Dev", "std")], 1)])
    issues = lines(s, [(1, "very_short_inputs", "short"), (3, "non_standard_types", "nonstd")]).unionByName(
        lines(dup, [(2, "duplicate_inputs", "dup")])).where(F.col("v") > 0)
    missing = missing_counts(base, F.col("entries")).where(F.col("n_missing") > 0)
    out = [_section("overview", overview, F.col("o"), F.col("k"), n=F.col("v")),
           _section("input_length", lengths, F.col("o"), F.col("k"), value=F.round("v", 6)),
           _section("issues", issues, F.col("o"), F.col("k"), n=F.col("v")),
           _section("missing", missing, F.col("first_row"), F.col("column"), F.col("n_missing"),
                    _pct(F.col("n_missing"), F.col("total")), ord2=F.col("first_pos"))]
    canonical = {"ticket_type": len({*TICKET_TYPE_MAPPING.values(), TICKET_TYPE_DEFAULT}),
                 "severity": len({*SEVERITY_MAPPING.values(), SEVERITY_DEFAULT}), "department_impacted": TOP_DEPARTMENTS}
    for col, most in canonical.items():
        top = distribution(base, col, top=most)          # at most ``most`` rows are put in order
        top = top.withColumn("o", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("value"))))
        out.append(_section(col.removesuffix("_impacted"), top, F.col("o"), F.col("value"), F.col("n"), F.col("pct")))
    report = out[0]
    for part in out[1:]:
        report = report.unionByName(part)
    return report
