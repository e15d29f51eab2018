"""Heavy words per class from bounded summaries (T2-T6 for vocabularies too large to shuffle).

Words are first counted by hash bucket: at most ``buckets`` rows per class and task are shuffled, however many
words there are.  A bucket's total is an upper bound of each of its words' counts.  The exact counts of the words
in the fullest buckets give a lower bound of the k-th count; every word whose bucket reaches it is then counted
exactly.  A word left out has a count of at most its bucket's, less than k other words have, so no top-k
word can be missing, ties included."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.functions.text import ascii_words
from ticketloom.operators.keywords import word_counts

BUCKETS = 1 << 16           # summary rows per class
CHOSEN_ROWS = 1_000_000     # (class, bucket) pairs that are broadcast; with more, all words are counted
PROBE = 2                   # fullest buckets per wanted word that give the lower bound


def heavy_word_counts(df: DataFrame, text_col: str, class_cols: list[str], top: int, buckets: int = BUCKETS,
                      chosen_rows: int = CHOSEN_ROWS) -> DataFrame:
    """``class_cols, word, n``: exact counts of a set of words that holds the ``top`` most frequent of each
    class, ties at the last place included.

    Null classes are a class.  Where more than ``chosen_rows`` pairs of class and bucket would have to be
    broadcast, every word is counted instead (``word_counts``); the top-k of both is the same."""
    words = (df.select(*class_cols, F.explode(ascii_words(text_col)).alias("word"))
             .withColumn("_bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int")))
    totals = words.groupBy(*class_cols, "_bucket").agg(F.count("*").alias("_total")).checkpoint(eager=True)
    ranked = Window.partitionBy(*class_cols).orderBy(F.desc("_total"), "_bucket")
    fullest = totals.withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") <= PROBE * top).drop("_r", "_total")
    counts = _recount(words, fullest, class_cols, chosen_rows)
    if counts is None:
        return word_counts(df, text_col, *class_cols)
    by_count = Window.partitionBy(*class_cols).orderBy(F.desc("n"), "word")
    bound = (counts.withColumn("_r", F.row_number().over(by_count)).where(F.col("_r") <= top)
             .groupBy(*class_cols).agg(F.when(F.count("*") == top, F.min("n")).otherwise(0).alias("_bound")))
    named = bound.select(*(F.col(c).alias(f"_{c}") for c in class_cols), "_bound")
    reached = totals.join(named, _same(class_cols)).where(F.col("_total") >= F.col("_bound")).select(*class_cols, "_bucket")
    counts = _recount(words, reached, class_cols, chosen_rows)
    return word_counts(df, text_col, *class_cols) if counts is None else counts


def _same(class_cols: list[str]):
    """Classes are equal to those whose columns carry an underscore; null equals null."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in class_cols], F.lit(True))


def _recount(words: DataFrame, chosen: DataFrame, class_cols: list[str], chosen_rows: int) -> DataFrame | None:
    """Exact counts of the words in the chosen buckets, or None if these are too many to broadcast."""
    chosen = chosen.checkpoint(eager=True)
    if chosen.count() > chosen_rows:
        return None
    named = chosen.select(*(F.col(c).alias(f"_{c}") for c in class_cols), F.col("_bucket").alias("_b"))
    kept = words.join(F.broadcast(named), _same(class_cols) & (F.col("_bucket") == F.col("_b")), "left_semi")
    return kept.groupBy(*class_cols, "word").agg(F.count("*").alias("n")).checkpoint(eager=True)
