"""Exact, repeatable, distributed ranks by hash (the shuffle behind
balancing, shuffling and splitting).

Order: rows sorted by ``md5(seed ':' id...)`` then by the id columns.  The
md5 hex is cut into buckets by its first ``digits`` characters, so bucket
order equals hash order.  One aggregate counts rows per (group, bucket);
an exclusive prefix sum over those counts (at most groups x 16^digits
rows) gives each bucket its starting position.  ``row_number`` then runs
only inside buckets -- never over a whole group, never in one task -- and
only where an exact position is needed; a split needs none, only the keys
at its cuts.  md5 is uniform, so a hot group is spread over all of its buckets.  Everything is deterministic, so a lost
executor recomputes the same positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DEFAULT_DIGITS = 4
BOUNDARY_ROWS = 10_000      # rows that are put in order to find a boundary key


def hash_key(seed: int, *cols) -> Column:
    """md5 hex of 'seed:c1:c2...' (same text in DuckDB: seed || ':' || ...)."""
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_int(seed: int, *cols) -> Column:
    """Non-negative 60-bit integer from the md5 of the key (for draws)."""
    return F.conv(F.substring(hash_key(seed, *cols), 1, 15), 16, 10).cast("bigint")


def bucket_offsets(df: DataFrame, key: Column, by: list[str], digits: int = DEFAULT_DIGITS):
    """Returns (rows with _h/_b, offsets with by.., _b, _cnt, _off, _n)."""
    d = df.withColumn("_h", key).withColumn("_b", F.substring("_h", 1, digits))
    counts = d.groupBy(*by, "_b").agg(F.count("*").alias("_cnt"))
    grp = Window.partitionBy(*by)
    before = grp.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("bigint"))
               .withColumn("_n", F.sum("_cnt").over(grp).cast("bigint")))
    return d, offsets.checkpoint(eager=True)     # cuts lineage, survives executor loss


def join_offsets(d: DataFrame, offsets: DataFrame, by: list[str]) -> DataFrame:
    """Rows joined to their bucket's offsets.  Group keys compare null-safe
    (a null group is a group, as in GROUP BY); ``<=>`` stays an equi-join
    key, and Spark picks the join by the offsets' size in bytes."""
    o = offsets
    for c in by:
        o = o.withColumnRenamed(c, f"_o_{c}")
    cond = d["_b"] == o["_b"]
    for c in by:
        cond = cond & d[c].eqNullSafe(o[f"_o_{c}"])
    j = d.join(o, cond)
    return j.drop(o["_b"]).drop(*[f"_o_{c}" for c in by])


def positions(df: DataFrame, key: Column, tie: list[str], by: list[str] | None = None,
              name: str = "pos", digits: int = DEFAULT_DIGITS) -> DataFrame:
    """Full 0-based rank of every row within ``by`` ordered by (key, tie)."""
    by = by or []
    d, offsets = bucket_offsets(df, key, by, digits)
    w = Window.partitionBy(*by, "_b").orderBy("_h", *tie)
    out = join_offsets(d, offsets, by).withColumn(name, F.col("_off") + F.row_number().over(w) - 1)
    return out.drop("_h", "_b", "_cnt", "_off", "_n")


def boundaries(ids: DataFrame, tie: list[str], cuts_of, digits: int = DEFAULT_DIGITS) -> tuple[int, list[int], list]:
    """``(rows, cuts, keys)``: the number of rows of ``ids`` (``_h`` and the tie columns), the positions
    ``cuts_of(rows)``, and for each the row ``(_h, *tie)`` at that place in hash order; null at or
    beyond the end.

    However many cuts there are, the ids are read twice: once to count hash prefixes (at most
    16**digits rows, which the driver sees), and once to keep the rows whose prefix holds a cut.  Only
    among those few are rows counted by longer prefixes and, once at most ``BOUNDARY_ROWS`` are
    left, put in order."""
    def count(rows, length):
        return sorted((r["_b"], r["_cnt"]) for r in rows.groupBy(F.substring("_h", 1, length).alias("_b")).agg(F.count("*").alias("_cnt")).collect())

    def find(counts, position):
        for prefix, size in counts:
            if position < size:
                return prefix, size, position
            position -= size

    counts = count(ids, digits)
    total = sum(n for _, n in counts)
    cuts = [int(c) for c in cuts_of(total)]
    hits = [find(counts, c) for c in cuts]
    wanted = sorted({h[0] for h in hits if h})
    if not wanted:
        return total, cuts, [None] * len(cuts)
    near = ids.where(F.substring("_h", 1, digits).isin(wanted)).checkpoint(eager=True)
    keys = []
    for hit in hits:
        while hit and hit[1] > BOUNDARY_ROWS and len(hit[0]) < 32:
            hit = find(count(near.where(F.col("_h").startswith(hit[0])), len(hit[0]) + digits), hit[2])
        keys.append(near.where(F.col("_h").startswith(hit[0])).orderBy("_h", *tie).limit(hit[2] + 1).collect()[hit[2]] if hit else None)
    return total, cuts, keys


def segments(df: DataFrame, key: Column, tie: list[str], cut_fn, labels: list[str],
             name: str = "segment", digits: int = DEFAULT_DIGITS) -> DataFrame:
    """Label rows by rank segment without ranking them.

    ``cut_fn(n) -> [c1, c2, ...]`` gives increasing cut positions from the
    total row count; rows with position < c1 get labels[0], c1 <= pos < c2
    labels[1], ..., the rest labels[-1].  The keys of the rows at the cuts
    come from ids alone (``boundaries``, two reads); all rows are then
    labelled in one projection by comparing their ``(hash, ids)`` with
    them: three reads in all, with no join, window or shuffle of rows.  The
    id columns must tell the rows apart."""
    total, cuts, rows = boundaries(df.select(key.alias("_h"), *tie), tie, cut_fn, digits)
    kind = dict(df.dtypes)
    mine = F.struct(key.alias("_h"), *tie)
    label = F.lit(labels[-1])
    for cut, row, lab in reversed(list(zip(cuts, rows, labels))):
        below = F.lit(cut >= total) if row is None else mine < F.struct(
            F.lit(row["_h"]).alias("_h"), *(F.lit(row[c]).cast(kind[c]).alias(c) for c in tie))
        label = F.when(below, F.lit(lab)).otherwise(label)
    return df.withColumn(name, label), total, cuts
