"""Exact dedup by a tree-merge of sorted digest runs.

Texts are equal when they are identical after deleting ASCII white space.  Each scan partition
sorts its digests into one run, one row per distinct text: ``(digest, count, best row)``.  In
round r runs whose numbers differ in bit r exchange the halves of their digests (a binomial
tree: partners are 2^r apart), and each task merges the sorted runs it gets, keeping of equal
digests - verified by SHA-256, XXH3 and length at every level - the count and the best row.
After the last round every run holds one digest range.  A digest held by a third of the rows is
one row per run from the start, so no task ever gathers its copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import attach, documents, materialize, partition_id, prepare

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
MAX_RUNS = 4096                         # partitions of a round; more runs are merged into as many first
SCHEMA = "row bigint, doc_id bigint, run bigint, digest binary, check bigint, n_bytes bigint, n_chars bigint"
SAME = ["digest", "check", "n_bytes"]   # rows merge only if both hashes and the length agree


def _digests(batches):
    run = partition_id()
    for batch in batches:
        digest, check, n_bytes, n_chars = [], [], [], []
        for text in batch.column("text").to_pylist():
            plain = text.encode().translate(None, SPACE)
            digest.append(hashlib.sha256(plain).digest())
            check.append(xxhash.xxh3_64_intdigest(plain) - (1 << 63))
            n_bytes.append(len(plain))
            n_chars.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array([run] * len(digest), pa.int64()),
             pa.array(digest, pa.binary()), pa.array(check, pa.int64()), pa.array(n_bytes, pa.int64()),
             pa.array(n_chars, pa.int64())],
            ["row", "doc_id", "run", "digest", "check", "n_bytes", "n_chars"])


def _merge(batches):
    """Rows in order of run and digest, best first, with equal digests of a run merged into their best row."""
    held = None                                 # the last digest so far, which the next batch may go on with
    for batch in batches:
        part = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not part.num_rows:
            continue
        new = np.ones(part.num_rows, bool)
        new[1:] = False
        for column in ("run", *SAME):
            c = part.column(column)
            new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy()
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(part.column("n").to_numpy(), starts)
        best = part.take(pa.array(starts))
        # the column's own field: a held row has the schema of the next batch
        best = best.set_column(best.schema.get_field_index("n"), best.schema.field("n"), pa.array(counts)).combine_chunks()
        yield from best.slice(0, len(starts) - 1).to_batches()
        held = best.slice(len(starts) - 1).to_batches()[0]
    if held is not None:
        yield held


def merge_runs(runs: DataFrame) -> DataFrame:
    """Each task's sorted runs as one, equal digests merged; the sort spills, the merge holds one batch."""
    return runs.sortWithinPartitions("run", *SAME, F.desc("best")).mapInArrow(_merge, runs.schema)


def tree_merge(runs: DataFrame, n_runs: int, max_runs: int = MAX_RUNS) -> DataFrame:
    """Merge ``(run, digest, check, n_bytes, n, best)`` rows, the largest ``best`` stays, until each digest is in
    one run only; runs are numbered from 0.

    More than ``max_runs`` (a power of two) are first merged, many at a time, into that many."""
    rounds = max(1, min(n_runs - 1, max_runs - 1).bit_length())
    prefix = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("bigint")
    runs = merge_runs(runs)
    if n_runs > 1 << rounds:
        fewer = runs.withColumn("run", F.col("run").bitwiseAND((1 << rounds) - 1))
        runs = merge_runs(fewer.repartitionById(1 << rounds, F.col("run").cast("int")))
    for r in range(rounds):
        wanted = F.shiftright(prefix, r).bitwiseAND(1)
        other = F.col("run").bitwiseAND(~(1 << r)).bitwiseOR(F.shiftleft(wanted, r)).cast("bigint")
        runs = merge_runs(runs.withColumn("run", other).repartitionById(1 << rounds, F.col("run").cast("int")))
    return runs


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: ``row, doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points stays, then the smallest id, then the
    smallest row number (so of wholly repeated rows exactly one is ``kept``).  Null text is
    empty text; a null id loses to every other id.  ``row_col`` names a unique bigint column
    to be used as ``row``; without it rows are numbered here.  Extra columns are ignored; an
    empty table gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    text = docs.select(row.alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = materialize(text.mapInArrow(_digests, SCHEMA))
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    # larger is better; the bitwise complement reverses an order without overflow
    best = F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row"))
    runs = rows.select("run", *SAME, F.lit(1).cast("bigint").alias("n"), best.alias("best"))
    merged = tree_merge(runs, n_runs).select(F.struct(*SAME).alias("key"), "n", F.col("best").alias("won"))
    out = attach(rows.withColumn("key", F.struct(*SAME)), merged, "key", "run")
    return out.select("row", "doc_id", F.bitwise_not(F.col("won.id")).alias("keep_id"),
                      F.col("n").alias("group_size"), (F.col("won.row") == F.bitwise_not("row")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("row")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn,
             count(*) OVER (PARTITION BY h) AS group_size
      FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, h AS text_sha256 FROM r
"""
