"""Phrase lists over rows (V4 with many keywords and phrases).

A text is the sequence of its words (``ascii_words``); a phrase occurs wherever its words stand in a row.
Rows are cut into the word runs of every length that the list holds, and the runs meet the list in an
equi-join, so the work per word is the number of different lengths, whatever the number of phrases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.fixed_values import OUT_OF_DOMAIN_ERROR
from ticketloom.functions.text import ascii_words

BROADCAST_BYTES = 32 << 20      # a larger phrase list is shuffled
SHORT = 8                       # words of the longest run that is read off one row per place
SALTS = 32                      # keys over which a common run is spread when the list is shuffled
ENTRY_BYTES = 64                # what a phrase takes beside its own bytes


def phrase_table(phrases: DataFrame, phrase_col: str = "phrase") -> DataFrame:
    """``phrase, n_words``: the different phrases, as their words joined by a space; those without words
    are left out."""
    words = phrases.select(ascii_words(phrase_col).alias("w")).where(F.size("w") > 0)
    return words.select(F.array_join("w", " ").alias("phrase"), F.size("w").alias("n_words")).distinct()


def word_runs(df: DataFrame, id_col: str, text_col: str, lengths: list[int]) -> DataFrame:
    """``id_col, place, phrase``: every run of as many words as one of ``lengths`` says, by its first word's
    place (from 0).  Short runs come from one row per place, which holds the words that follow; if there are
    long ones, rows are exploded by length first, so a long text is never held once per word of a length."""
    words = df.select(id_col, ascii_words(text_col).alias("_w"))
    if lengths[-1] <= SHORT:
        ahead = F.arrays_zip(*(F.slice("_w", k, F.size("_w")).alias(str(k)) for k in range(1, lengths[-1] + 1)))
        # outer: no filter on the words, which would cut every text again, is put before it
        places = words.select(id_col, F.posexplode_outer(ahead).alias("place", "_z"))

        def run(n):                                         # null where the text ends before
            return reduce(lambda left, k: F.concat(left, F.lit(" "), F.col("_z")[str(k)]), range(2, n + 1), F.col("_z")["1"])
        return places.select(id_col, "place", F.explode(F.array(*map(run, lengths))).alias("phrase")).where("phrase IS NOT NULL")
    sized = words.select(id_col, "_w", F.explode(F.array(*map(F.lit, lengths))).alias("_n")).where(F.size("_w") >= F.col("_n"))
    runs = F.transform(F.sequence(F.lit(1), F.size("_w") - F.col("_n") + 1),
                       lambda i: F.struct((i - 1).alias("place"), F.array_join(F.slice("_w", i, F.col("_n")), " ").alias("phrase")))
    return sized.select(id_col, F.explode(runs).alias("_r")).select(id_col, "_r.place", "_r.phrase")


def _found(df: DataFrame, phrases: DataFrame, id_col: str, text_col: str, phrase_col: str = "phrase",
           broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """``id_col, place, phrase, n_words, _p``: every occurrence, with the phrase's number beside it."""
    table = phrase_table(phrases, phrase_col).withColumn("_p", F.monotonically_increasing_id()).checkpoint(eager=True)
    sizes = table.groupBy("n_words").agg(F.sum(F.octet_length("phrase") + ENTRY_BYTES).alias("bytes")).collect()
    if not sizes:
        return df.select(id_col, F.lit(0).alias("place"), F.lit("").alias("phrase"), F.lit(0).alias("n_words"), F.lit(0).alias("_p")).limit(0)
    runs = word_runs(df, id_col, text_col, sorted(r["n_words"] for r in sizes))
    if sum(r["bytes"] for r in sizes) <= broadcast_bytes:
        return runs.join(F.broadcast(table), "phrase")
    spread = table.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = runs.withColumn("_s", F.pmod(F.xxhash64(id_col, "place"), F.lit(salts)).cast("int"))
    return salted.join(spread, ["phrase", "_s"])


def phrase_matches(df: DataFrame, phrases: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """``id_col, place, phrase, n_words``: every occurrence of every phrase, overlapping ones too.

    The list's size is taken first: up to ``broadcast_bytes`` it is broadcast; a larger one is shuffled,
    once per salt, so that a run which a third of the texts hold is spread over ``salts`` keys.  Null texts and
    empty lists match nothing."""
    return _found(df, phrases, id_col, text_col, **options).select(id_col, "place", "phrase", "n_words")


def phrase_scores(df: DataFrame, phrases: DataFrame, id_col: str, text_col: str, threshold: int = 1, **options) -> DataFrame:
    """V4: ``id_col, n_matches, n_phrases, in_domain, error`` of each row: occurrences, different phrases, whether
    these reach ``threshold``, and the ``error`` ticket of a row that doesn't (null for others).  Ids are
    unique; rows with a null id count as one row."""
    found = _found(df, phrases, id_col, text_col, **options)
    per = (found.groupBy(id_col, "_p").agg(F.count("*").alias("n"))          # by number: short keys in the shuffle
           .groupBy(F.col(id_col).alias("_id")).agg(F.sum("n").alias("n_matches"), F.count("*").alias("n_phrases")))
    ids = df.select(id_col).distinct()
    out = ids.join(per, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    n = F.coalesce("n_phrases", F.lit(0))
    return out.select(id_col, F.coalesce("n_matches", F.lit(0)).alias("n_matches"), n.alias("n_phrases"),
                      (n >= threshold).alias("in_domain"), F.when(n < threshold, F.lit(OUT_OF_DOMAIN_ERROR)).alias("error"))
