"""Training-data pipeline over ``documents``: each stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import exact_dedup, packing, pii, quality, simhash
from ticketloom.llm.common import documents, numbered_rows, prepare
from ticketloom.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text the classifier predicts to be bad (score under 0.5), whatever their
    id: rows that share an id, or have none, are judged each by its own text; null counts as empty."""
    rows, row = numbered_rows(docs)
    scores = quality.quality_scores(rows, documents(spark, sf_dir, "labels"), row_col=row)
    return _without(rows, row, scores.where("predicted = 0"), docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal without blanks: the one with the most characters,
    then the smallest id (nulls last), then the first; null counts as empty."""
    rows, row = numbered_rows(docs)
    return _without(rows, row, exact_dedup.exact_dedup(rows, row_col=row).where(~F.col("kept")), docs.columns)


def simhash_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that of the smallest id (nulls last), and of rows
    that share it, or if all ids are null, the first; null counts as empty."""
    rows, row = numbered_rows(docs)
    return _without(rows, row, simhash.simhash_dedup(rows, row_col=row).where(~F.col("kept")), docs.columns)


def _without(rows: DataFrame, row: str, gone: DataFrame, columns: list[str]) -> DataFrame:
    return rows.join(gone.select(F.col("row").alias(row)), row, "left_anti").select(*(F.col(f"`{c}`") for c in columns))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data; every document stays, nulls as they are, and ``n_chars``, if there is such a
    column, counts the new text."""
    done = pii.surrogate_pii(docs)
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))


def lexical_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents that are left; one row per piece.  Null counts as empty, repeated rows and ids are
    packed each."""
    ranks = packing.read_vocabulary(public_tokenizers.path(packing.VOCABULARY))
    return packing.pack_documents(docs, ranks).withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", simhash_duplicates),
    ("pii_surrogates", pii_surrogates),
    ("lexical_packing", lexical_packing),
]

ORACLE_SQL = None          # no stage but the second can be stated in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
