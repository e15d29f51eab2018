"""Reading the driver's parquet tables with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketloom.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """``spark.read.parquet`` of one table; only ``columns`` reach the scan's
    ReadSchema when given.  Partitioning is the scan's own at every size."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
