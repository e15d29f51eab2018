"""A profile that grows day by day.

A day's rows are reduced once to a few stored rows: exact counts, sums, smallest and largest length, and Spark's
mergeable sketches (HyperLogLog for different values, KLL for quantiles).  Adding a day reads that day's rows only;
the profile of any set of days merges stored rows and never goes back to the texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K, KLL_K = 12, 400
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)     # relative, three standard errors
RANK_ERROR = 0.01                               # of a quantile's rank, for KLL_K


def day_summaries(df: DataFrame, day_col: str, by: list[str], text_col: str, distinct_cols: list[str]) -> DataFrame:
    """One row per day and group ``by``.  Lengths are those of ``text_col``; null texts count as rows only, null
    values not as different ones."""
    n = F.length(text_col).cast("bigint")
    square = n.cast("decimal(38,0)") * n.cast("decimal(38,0)")
    return df.groupBy(day_col, *by).agg(
        F.count("*").alias("n_rows"), F.count(text_col).alias("n_texts"), F.sum(n).alias("sum_length"),
        F.sum(square.cast("decimal(28,0)")).alias("sum_squares"), F.min(n).alias("min_length"), F.max(n).alias("max_length"),
        F.kll_sketch_agg_bigint(n, F.lit(KLL_K)).alias("lengths"),
        *(F.hll_sketch_agg(c, F.lit(LG_K)).alias(f"distinct_{c}") for c in distinct_cols))


def store_summaries(summaries: DataFrame, day_col: str, path: str) -> None:
    """Adds days to the stored ones; a day that is there already is replaced, so a repeated run changes nothing."""
    (summaries.repartition(day_col).write.partitionBy(day_col).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge_summaries(summaries: DataFrame, by: list[str]) -> DataFrame:
    """The summaries of several days as one row per group ``by``: the same columns."""
    distinct = [c for c in summaries.columns if c.startswith("distinct_")]
    return summaries.groupBy(*by).agg(
        *(F.sum(c).alias(c) for c in ("n_rows", "n_texts", "sum_length", "sum_squares")),
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
        F.kll_merge_agg_bigint("lengths", F.lit(KLL_K)).alias("lengths"), *(F.hll_union_agg(c).alias(c) for c in distinct))


def summary_profile(merged: DataFrame, by: list[str]) -> DataFrame:
    """A4 and A6 of merged summaries: ``n_rows, n_texts, mean, std, min, max`` are exact (std is null under two
    texts); ``median`` has a rank within ``RANK_ERROR`` of the middle and ``unique_*`` lie within
    ``DISTINCT_ERROR`` of the number, relatively, as their sketches promise."""
    n, s, q = (F.col(c).cast("decimal(38,0)") for c in ("n_texts", "sum_length", "sum_squares"))
    spread = (n * q - s * s).cast("double")
    count = F.col("n_texts").cast("double")
    return merged.select(
        *by, "n_rows", "n_texts", F.round(F.try_divide(F.col("sum_length").cast("double"), count), 6).alias("mean"),
        F.when(F.col("n_texts") > 1, F.round(F.sqrt(F.try_divide(spread, count * (count - 1))), 6)).alias("std"),
        F.col("min_length").alias("min"), F.col("max_length").alias("max"),
        F.when(F.col("n_texts") > 0, F.kll_sketch_get_quantile_bigint("lengths", F.lit(0.5))).alias("median"),
        *(F.hll_sketch_estimate(c).alias(c.replace("distinct_", "unique_", 1))
          for c in merged.columns if c.startswith("distinct_")))


def check_profile(profile: DataFrame, df: DataFrame, by: list[str], text_col: str, distinct_cols: list[str]) -> DataFrame:
    """The profile beside a full run over the rows: its exact columns, whether the median's rank and the different
    values lie within the stated errors, and the exact number of these."""
    n = F.length(text_col)
    mine = profile.select(*(F.col(c).alias(f"_{c}") for c in by), "median", *(f"unique_{c}" for c in distinct_cols),
                          "n_rows", "n_texts", "mean", "std", "min", "max")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    middle = df.select(*by, n.alias("_n")).join(F.broadcast(mine.select(*(f"_{c}" for c in by), "median")), same)
    ranks = middle.groupBy(*by).agg(F.try_divide(F.count_if(F.col("_n") < F.col("median")), F.count("_n")).alias("below"),
                                    F.try_divide(F.count_if(F.col("_n") <= F.col("median")), F.count("_n")).alias("upto"))
    full = df.groupBy(*by).agg(*(F.countDistinct(c).alias(f"exact_{c}") for c in distinct_cols))
    both = ranks.select(*(F.col(c).alias(f"_{c}") for c in by), "below", "upto")
    checked = full.join(mine, same).drop(*(f"_{c}" for c in by)).join(both, same)
    near = [(F.abs(F.col(f"unique_{c}") - F.col(f"exact_{c}")) <= F.lit(DISTINCT_ERROR) * F.col(f"exact_{c}")).alias(f"{c}_within")
            for c in distinct_cols]
    in_rank = ((F.col("below") - RANK_ERROR <= 0.5) & (F.col("upto") + RANK_ERROR >= 0.5)).alias("median_within")
    return checked.select(*by, "n_rows", "n_texts", "mean", "std", "min", "max",
                          *(F.col(f"exact_{c}").alias(f"unique_{c}") for c in distinct_cols), in_rank, *near)
