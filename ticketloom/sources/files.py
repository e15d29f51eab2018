"""File sources and sinks.

Written tables go to a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``), never to a machine-local path on a cluster.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.operators.clean import csv_nulls
from ticketloom.operators.records import sample_json_element, sample_json_line, validate_samples
from ticketloom.session import scratch_path
from ticketloom.sources.splitting import csv_records, file_offsets, json_array_elements, numbered_lines, range_bytes

MAX_WRITE_TASKS = 10_000         # a task writes as many files as it has parts
FILE_BYTES = 64 << 20            # of a file whose rows one task gathers

_CSV = {"header": "true", "quote": '"', "escape": '"'}


def write_tickets_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, every field quoted, quotes doubled, whitespace kept
    (texts hold newlines and quotes)."""
    (df.write.options(**_CSV).option("quoteAll", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .mode("overwrite").csv(path))
    return path


def read_tickets_csv(spark: SparkSession, path: str, split: bool | None = None, range_size: int | None = None) -> DataFrame:
    """``pd.read_csv`` semantics on a cluster: columns by the header's names (no inference pass),
    quoted fields with line breaks, and pandas' null spellings mapped to null after the scan.

    ``row_index`` is the file's own column if it has one; else rows are numbered 0..n-1 by file name and
    place.  A missing ``input`` or ``output`` column is an error, and so are files whose headers differ.

    ``split`` reads a file by many tasks (``splitting.csv_records``); it needs quotes to stand around fields
    and to be doubled inside.  Without it a file is one task, and quotes inside unquoted fields are
    text.  None splits if a file is larger than one range, as only then it gives more tasks.
    ``range_size`` is the bytes of a range (default: the session's)."""
    if split is None:
        sizes = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]     # reads no content
        split = (sizes or 0) > (range_size or _range_size(spark))
    if split:
        with range_bytes(spark, range_size):
            records = csv_records(spark, path)
        # one name list may be quoted in a few ways
        headers = [r.record for r in records.where("row IS NULL").select("record").distinct().limit(16).collect()]
        lists = {tuple(next(csv.reader([h]))) for h in headers}
        if len(lists) > 1:
            raise ValueError(f"the headers of {path} differ: {sorted(lists)}")
        names = list(next(iter(lists), []))
        _require(names, path)
        fields = ", ".join(f"_c{k} string" for k in range(len(names)))
        parsed = F.from_csv("record", fields, {**_CSV, "header": "false", "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
                                               "ignoreTrailingWhiteSpace": "false"})
        field = lambda name: F.col(f"_f._c{names.index(name)}")
        df = records.where("row IS NOT NULL").withColumn("_f", parsed).select(
            (field("row_index").cast("bigint") if "row_index" in names else F.col("row")).alias("row_index"),
            field("input").alias("input"), field("output").alias("output"))
        return csv_nulls(df, "input", "output")
    df = (spark.read.options(**_CSV).option("multiLine", "true").option("ignoreLeadingWhiteSpace", "false")
          .option("ignoreTrailingWhiteSpace", "false").csv(path))
    _require(df.columns, path)
    if "row_index" in df.columns:
        df = df.withColumn("row_index", F.col("row_index").cast("bigint"))
    else:
        df = _numbered(df)
    return csv_nulls(df.select("row_index", "input", "output"), "input", "output")


def _range_size(spark: SparkSession) -> int:
    """Bytes of a file range; the setting may be written as 128m."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _require(names: list[str], path: str) -> None:
    lost = [c for c in ("input", "output") if c not in names]
    if lost:
        raise ValueError(f"{path} has no column {', '.join(lost)}")


def _numbered(df: DataFrame) -> DataFrame:
    """``row_index`` by file name and place.  Rows of one file block come in
    order in one task, so a row's place is counted from its block's first
    row; only the blocks (not the rows) are put in order."""
    block = ["_file", "_start"]
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                     F.monotonically_increasing_id().alias("_id")).checkpoint(eager=True)
    blocks = rows.groupBy(*block).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (rows.join(blocks, block).withColumn("row_index", F.col("_off") + F.col("_id") - F.col("_first"))
            .drop(*block, "_id", "_first", "_n", "_off"))


def write_samples_jsonl(samples: DataFrame, path: str, partition_by: str | None = None) -> str:
    """K1/K2: one JSON object per line ({"user_input", "ticket_data"}), key
    presence kept exactly; optionally one folder per split."""
    cols = [sample_json_line().alias("value")]
    if partition_by:
        cols.append(F.col(partition_by))
    w = samples.select(*cols).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)
    return path


def read_samples_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """S2 (JSON Lines): text lines -> validated samples (F6), key absence
    preserved because the objects are parsed as maps, not into a struct.
    A partition column found in the folder names is kept."""
    raw = spark.read.text(path)
    extra = [c for c in raw.columns if c != "value"]
    # a per-read row label only; ``read_numbered_samples`` gives lasting ones
    raw = raw.select(F.monotonically_increasing_id().alias("sample_id"),
                     F.col("value").alias("sample_json"), *extra)
    return validate_samples(raw, keep=tuple(extra))


def read_numbered_samples(spark: SparkSession, path: str, range_size: int | None = None) -> DataFrame:
    """S2/B6 (JSON Lines): as ``read_samples_jsonl``, with ``sample_id`` 0..n-1 by file name and line, the
    same on every read.  A blank line is a sample that is not valid."""
    with range_bytes(spark, range_size):
        lines = numbered_lines(spark, path)
    return validate_samples(lines.select(F.col("line").alias("sample_id"), F.col("value").alias("sample_json")))


def write_sample_arrays(raw_samples: DataFrame, path: str, per_file: int = 1000) -> str:
    """K1: samples as JSON arrays, ``per_file`` ids to a file, as ``json.dump``
    writes a list."""
    group = F.floor(F.col("sample_id") / per_file).alias("_file")
    items = F.transform(F.sort_array(F.collect_list(F.struct("sample_id", "sample_json"))), lambda x: x["sample_json"])
    (raw_samples.groupBy(group).agg(F.concat(F.lit("[\n"), F.array_join(items, ",\n"), F.lit("\n]")).alias("value"))
     .write.mode("overwrite").partitionBy("_file").text(path))
    return path


def files_for(df: DataFrame, *cols: str) -> int:
    """In how many files of about ``FILE_BYTES`` the text of ``cols`` fits; at least one."""
    size = df.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in cols), F.lit(0)))).first()[0]
    return max(1, -(-(size or 0) // FILE_BYTES))


def write_json_array(elements: DataFrame, path: str, order: list[str], text: str = "element", per_file: int | None = 100_000) -> str:
    """K1: JSON arrays in the bytes of ``json.dump(list, indent=2)`` (and a line break at the end of a file),
    from element texts rendered at level 1; ``per_file`` elements to a file, the last has the rest (None: as
    many as make about ``FILE_BYTES``).
    Files by name hold the elements by ``order``; no elements give one file with ``[]``.

    The elements are sorted once into the shared folder, where a row's file and place give its position
    and so its file and what stands before and after it.  The text writer cuts files after
    ``per_file`` rows and commits them at the end, so a failed task or job leaves no file behind."""
    spark = elements.sparkSession
    kept = scratch_path(spark, "elements")
    elements.orderBy(*order).select(F.col(text).alias("text")).write.parquet(kept)
    rows = spark.read.parquet(kept)
    total = rows.count()
    if not total:
        spark.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path
    if per_file is None:
        per_file = -(-total // files_for(rows, "text"))
    rows = rows.select("text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("k"))
    offsets = file_offsets(rows.groupBy("file").agg(F.count("*").alias("n")), "n")
    at = F.col("offset") + F.col("k")
    rows = rows.join(offsets, "file").select("text", at.alias("at"), F.floor(at / per_file).alias("part"))
    opens, ends = F.col("at") % per_file == 0, (F.col("at") % per_file == per_file - 1) | (F.col("at") == total - 1)
    value = F.concat(F.when(opens, F.lit("[\n")).otherwise(F.lit("")), F.lit("  "), F.col("text"),
                     F.when(ends, F.lit("\n]")).otherwise(F.lit(",")))
    tasks = min(-(-total // per_file), MAX_WRITE_TASKS)
    (rows.repartitionByRange(tasks, "part").sortWithinPartitions("at").select(value.alias("value"))
     .write.mode("overwrite").option("maxRecordsPerFile", per_file).text(path))
    return path


def write_sample_array(samples: DataFrame, path: str, order: list[str], per_file: int | None = 100_000) -> str:
    """K1: samples as the training script's list of {user_input, ticket_data}."""
    return write_json_array(samples.select(*order, sample_json_element().alias("element")), path, order, per_file=per_file)


def read_sample_array(spark: SparkSession, path: str, split: bool | None = None, range_size: int | None = None) -> DataFrame:
    """S2 (one JSON array per file, as ``json.dump`` writes it): both keys as VARIANT, so absence (SQL null)
    and JSON null stay apart, then validated: a present null input is kept, a ticket that is no object
    is skipped.

    ``split`` reads a file by many tasks (``splitting.json_array_elements``) and numbers the elements 0..n-1
    by file name and place; without it a file is one task and ``sample_id`` a label of this read.
    None splits if a file is larger than one range of ``range_size`` bytes (default: the session's)."""
    if split is None:
        sizes = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
        split = (sizes or 0) > (range_size or _range_size(spark))
    if split:
        with range_bytes(spark, range_size):
            raw = json_array_elements(spark, path)
        return validate_samples(raw.select(F.col("element").alias("sample_id"), F.to_json("value").alias("sample_json")))
    df = spark.read.option("multiLine", "true").schema("user_input variant, ticket_data variant").json(path)
    member = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f'"{c}": '), F.to_json(F.col(c))))
    line = F.concat(F.lit("{"), F.concat_ws(", ", member("user_input"), member("ticket_data")), F.lit("}"))
    raw = df.select(F.monotonically_increasing_id().alias("sample_id"), line.alias("sample_json"))
    return validate_samples(raw)


def write_eval_results(evaluated: DataFrame, path: str) -> str:
    """K5: the results folder: ``detailed_results`` of compared rows as JSON
    lines ({input, true, predicted, type_correct, field_match}; field_match
    holds only the fields that apply, assistance_request only for
    assistance), ``labels`` (sample_id, true label, prediction) of all rows
    and ``metrics`` (the report's long table)."""
    from ticketloom.operators.metrics import eval_report
    from ticketloom.operators.responses import MATCH_COLUMNS
    fields = [c[: -len("_match")] for c in MATCH_COLUMNS]
    matches = F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(f).alias("key"), F.col(c).alias("value")) for f, c in zip(fields, MATCH_COLUMNS)]),
        lambda e: e["value"].isNotNull()))
    line = F.to_json(F.struct(F.col("user_input").alias("input"), F.col("truth").alias("true"),
                              F.col("pred").alias("predicted"), F.col("type_correct"),
                              matches.alias("field_match")))
    evaluated = evaluated.checkpoint(eager=True)
    evaluated.where(F.col("outcome") == "compared").select(line.alias("value")).write.mode("overwrite").text(f"{path}/detailed_results")
    evaluated.select("sample_id", "true_label", "pred_label").write.mode("overwrite").json(f"{path}/labels")
    eval_report(evaluated).write.mode("overwrite").json(f"{path}/metrics")
    return path
