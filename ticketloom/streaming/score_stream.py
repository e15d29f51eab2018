"""Continuous scoring (V3): Structured Streaming over a folder of messages.

blank messages dropped (F9) -> caller's model per Arrow batch (V1) -> reply
parsed (E1) -> parquet sink with a checkpoint.  The query is stateless (no
time column, no aggregation), so it needs no watermark; the checkpoint
makes it exactly-once across restarts and executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.text import py_strip
from ticketloom.operators.responses import parse_replies
from ticketloom.operators.scoring import ModelFactory, score


def scoring_stream(stream: DataFrame, model_factory: ModelFactory, text_col: str) -> DataFrame:
    """The streaming transformation (also usable on a batch DataFrame)."""
    live = stream.where(F.length(py_strip(F.col(text_col))) > 0)
    scored = score(live, model_factory, text_col=text_col, out="response")
    return parse_replies(scored).drop("pred")


def run_available(spark: SparkSession, source_path: str, schema: str, model_factory: ModelFactory,
                  text_col: str, out_path: str, checkpoint: str, where: str | None = None,
                  max_files_per_trigger: int | None = 1000, max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Processes everything available in ``source_path`` (trigger
    availableNow), waits, and returns the sink folder as a DataFrame.  A
    backlog is worked off in batches of ``max_files_per_trigger`` files (or
    ``max_bytes_per_trigger``), each committed by itself."""
    reader = spark.readStream.schema(schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_path)
    if where:
        src = src.where(where)
    scored = scoring_stream(src, model_factory, text_col)
    q = (scored.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return spark.read.schema(scored.schema).parquet(out_path)
