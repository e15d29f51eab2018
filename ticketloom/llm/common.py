"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import ensure_checkpoint_dir, scratch_path, ship_package, table_path

TEXTS = "batch bigint, doc_ids array<bigint>, sizes array<bigint>, body binary"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def prepare(spark: SparkSession) -> None:
    """Shared folder for lineage cuts, and this package on the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder (``spark.checkpoint.dir``)."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def narrow_input(df: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """``(doc_id bigint, text string)``; further columns, whatever their names, are left out
    and null texts count as empty.  ``row_col`` names a bigint column that is kept as ``row``."""
    return df.select(*([F.col(row_col).alias("row")] if row_col else []), F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def numbered_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a bigint that no other row has, and the name of its column, which no input column has.

    The number is a row's file and place in it, so it stays what it was however the files are cut into
    tasks.  Rows that do not come straight from Parquet files are written to the shared folder first.
    The list of files, which the driver holds anyway, is broadcast."""
    spark = docs.sparkSession
    taken = {c.lower() for c in docs.columns}
    name, file = "__row", "__file"
    while name in taken or file in taken:
        name, file = name + "_", file + "_"
    place = [F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(name)]
    try:
        if "_metadata" in taken:
            raise AnalysisException("an own column hides the files' metadata")
        rows = docs.select("*", *place)
    except AnalysisException:
        path = scratch_path(spark, "numbered")
        docs.withColumnsRenamed({c: f"c{k}" for k, c in enumerate(docs.columns)}).write.parquet(path)
        rows = spark.read.parquet(path).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)), *place)
    paths = sorted(r[0] for r in rows.select(file).distinct().collect())
    numbers = spark.createDataFrame([(p, k << 40) for k, p in enumerate(paths)], f"`{file}` string, __first bigint")
    numbers = F.broadcast(numbers.withColumnRenamed("__first", file + "_first"))
    return rows.join(numbers, file).select(*(F.col(f"`{c}`") for c in docs.columns), (F.col(file + "_first") + F.col(name)).alias(name)), name


def partition_id() -> int:
    """Number of the running task's partition: the same when the task is repeated."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def held_out(id_col: str | Column) -> Column:
    """crc32 of the id as text, mod 3, is 1 (a null id counts as empty text)."""
    text = F.coalesce(F.col(id_col) if isinstance(id_col, str) else id_col, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % 3 == 1


def attach(rows: DataFrame, table: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows`` left-joined to ``table`` (one row per ``key``).

    A key that a third of the rows hold must not meet in one task, so the table is first
    joined to the distinct ``(key, spread)`` pairs, and the rows join on both columns."""
    pairs = rows.select(key, spread).distinct()
    return rows.join(pairs.join(table, key, "inner"), [key, spread], "left")


def gathered(batches: Iterator, limit: int) -> Iterator[tuple[int, list, list[bytes]]]:
    """``(doc_id, text)`` rows of Arrow batches in groups of about ``limit`` bytes of text (or one text): the group's
    number, ids and texts as they came.  Groups are numbered by partition, and so the same when a task or the scan is repeated."""
    number = partition_id() << 32
    ids, texts, size = [], [], 0
    for batch in batches:
        for k in range(0, batch.num_rows, 256):        # few texts at a time as Python strings
            part = batch.slice(k, 256)
            for i, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                data = text.encode()
                if texts and size + len(data) > limit:
                    yield number, ids, texts
                    number += 1
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(data)
                size += len(data)
    if texts:
        yield number, ids, texts


def text_batches(limit: int) -> Callable[[Iterator], Iterator]:
    """A ``mapInArrow`` function that gathers ``(doc_id, text)`` rows into rows of ``TEXTS``: about
    ``limit`` bytes of compressed texts (or one text), numbered by partition, and so the same when a
    task or the scan is repeated.  Rows are ordered by id, nulls last, then as they came."""
    def run(batches):
        for number, ids, texts in gathered(batches, limit):
            # in the order in which documents come first; rows of one id stay in their order
            order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, k))
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts[k] for k in order))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([[ids[k] for k in order]], pa.list_(pa.int64())),
                 pa.array([[len(texts[k]) for k in order]], pa.list_(pa.int64())), pa.array([body], pa.binary())],
                ["batch", "doc_ids", "sizes", "body"])
    return run


def chained(*steps: Callable) -> Callable[[Iterator], Iterator]:
    """Some ``mapInArrow`` functions as one, so that they share a Python worker's memory."""
    def run(batches):
        for step in steps:
            batches = step(batches)
        return batches
    return run


def batch_texts(row: dict) -> list[bytes]:
    """The texts of a ``TEXTS`` row."""
    body = zstandard.ZstdDecompressor().decompress(row["body"]) if sum(row["sizes"]) else b""
    out, at = [], 0
    for size in row["sizes"]:
        out.append(body[at:at + size])
        at += size
    return out


def each_row(batches: Iterator, columns: list[str]) -> Iterator[dict]:
    """The rows of Arrow batches, one at a time, for rows that are large."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in columns}
            pa.default_memory_pool().release_unused()      # what a large row took is given back
