"""Keyword mining.

Words are counted per row and combined partially before the shuffle (no
class text is ever concatenated into one string).  The top-k per class is
``row_number() <= k``, which Spark plans as a partial WindowGroupLimit on
the map side, so only k rows per class and task cross the shuffle even when
one class holds most of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.fixed_values import (
    HIGH_SEVERITIES, HIGH_SEVERITY_KEYWORDS_TOP, HIGH_SEVERITY_STOPWORDS, KEYWORDS_KEEP,
    KEYWORDS_MIN_LEN, KEYWORDS_PRINTED, STANDARD_TYPES, TYPE_KEYWORDS_TOP, TYPE_STOPWORDS)
from ticketloom.functions.text import ascii_words


def word_tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """T1 per row: number of words and a digest of the whole word list."""
    w = ascii_words(text_col)
    return df.select(id_col, F.size(w).cast("bigint").alias("n_words"),
                     F.md5(F.array_join(w, " ")).alias("words_md5"))


def word_counts(df: DataFrame, text_col: str, *group_cols: str) -> DataFrame:
    """Counter of words per group (explode + partial/final count)."""
    return (df.select(*group_cols, F.explode(ascii_words(text_col)).alias("word"))
            .groupBy(*group_cols, "word").agg(F.count("*").alias("n")))


def top_keywords(counts: DataFrame, group_cols: list[str], top: int, stopwords: list[str],
                 keep: int = KEYWORDS_KEEP, min_len: int = KEYWORDS_MIN_LEN) -> DataFrame:
    """most_common(top), then drop stopwords and short words, then keep
    the first ``keep`` (the filter comes after the top-k, so fewer than
    ``keep`` may remain).  Ties break by word, ascending."""
    order = [F.desc("n"), F.asc("word")]
    if group_cols:
        r = counts.withColumn("_r", F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order)))
        r = r.where(F.col("_r") <= top)
    else:  # global top-k: TakeOrderedAndProject
        r = counts.orderBy(*order).limit(top)
        r = r.withColumn("_r", F.row_number().over(Window.orderBy(*order)))
    kept = r.where(~F.col("word").isin(stopwords) & (F.length("word") >= min_len))
    w2 = Window.partitionBy(*group_cols).orderBy("_r") if group_cols else Window.orderBy("_r")
    return (kept.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= keep)
            .select(*group_cols, F.col("rank").cast("bigint").alias("rank"), "word", "n"))


def class_keywords(clean: DataFrame, text_col: str = "original_input",
                   class_col: str = "ticket_type", classes=STANDARD_TYPES) -> DataFrame:
    """Keywords per ticket type (long form: class, rank, word, n)."""
    src = clean.where(F.col(class_col).isin(list(classes))) if classes else clean
    counts = word_counts(src, text_col, class_col)
    return top_keywords(counts, [class_col], TYPE_KEYWORDS_TOP, TYPE_STOPWORDS)


def high_severity_keywords(clean: DataFrame, text_col: str = "original_input") -> DataFrame:
    """T4: keywords of high/critical rows (top 15, 12 stopwords)."""
    src = clean.where(F.col("severity").isin(HIGH_SEVERITIES))
    return top_keywords(word_counts(src, text_col), [], HIGH_SEVERITY_KEYWORDS_TOP,
                        HIGH_SEVERITY_STOPWORDS)


def keyword_patterns(clean: DataFrame, text_col: str = "original_input") -> DataFrame:
    """All four keyword lists in one long table (pattern, rank, word, n).
    The texts are tokenised once: one count per (type, high, word), from
    which both kinds of lists are summed."""
    high = F.col("severity").isin(HIGH_SEVERITIES).alias("high")
    counts = word_counts(clean.select("ticket_type", high, text_col), text_col, "ticket_type", "high").checkpoint(eager=True)
    of_type = (counts.where(F.col("ticket_type").isin(list(STANDARD_TYPES)))
               .groupBy("ticket_type", "word").agg(F.sum("n").alias("n")))
    of_high = counts.where("high").groupBy("word").agg(F.sum("n").alias("n"))
    by_type = top_keywords(of_type, ["ticket_type"], TYPE_KEYWORDS_TOP, TYPE_STOPWORDS).select(
        F.concat(F.col("ticket_type"), F.lit("_keywords")).alias("pattern"), "rank", "word", "n")
    high_words = top_keywords(of_high, [], HIGH_SEVERITY_KEYWORDS_TOP, HIGH_SEVERITY_STOPWORDS).select(
        F.lit("high_severity_keywords").alias("pattern"), "rank", "word", "n")
    return by_type.unionByName(high_words)


def printed_keywords(patterns: DataFrame, k: int = KEYWORDS_PRINTED) -> DataFrame:
    """The first ``k`` keywords of each pattern joined by ', '."""
    firsts = patterns.where(F.col("rank") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return firsts.groupBy("pattern").agg(
        F.array_join(F.transform(ordered, lambda x: x["word"]), ", ").alias("keywords"))
