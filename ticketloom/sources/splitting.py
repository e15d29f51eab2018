"""Text files read in splits although their records do not end at line breaks.

Spark's text source cuts any file into byte ranges and gives each piece up to a separator to one range.
What state a range starts in (inside quotes? how deep in brackets?) is the composition of the ranges
before it: each range is summed up under every state it could start in, and a prefix over the
ranges of a file picks the right one.  So a single large file is read by as many tasks as it has
ranges, and rows get exact numbers.

Pieces are written once to the shared folder, so ranges and numbers stay what they were when an
executor is lost or the file would be cut otherwise on a second read."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.session import scratch_path, ship_package

_RANGE = ["file", "block"]
_STRICT = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "false", "allowNumericLeadingZeros": "false",
           "allowNonNumericNumbers": "true"}
_RANGE_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def range_bytes(spark: SparkSession, size: int | None):
    """Within the block, files are cut into ranges of ``size`` bytes (None: as the session says)."""
    before = spark.conf.get(_RANGE_BYTES)
    if size is not None:
        spark.conf.set(_RANGE_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(_RANGE_BYTES, before)


def pieces(spark: SparkSession, path: str, sep: str = "\n", **more: Column) -> DataFrame:
    """``(file, block, id, value, *more)`` of the texts between separators (which are cut off), kept in the
    shared folder.  ``block`` is the byte where the piece's range starts; ``id`` orders the pieces of a
    range, without holes.  ``more`` are columns computed from ``value``."""
    out = scratch_path(spark, "pieces")
    (spark.read.option("lineSep", sep).text(path)
     .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
             F.monotonically_increasing_id().alias("id"), "value", *(c.alias(n) for n, c in more.items()))
     .write.parquet(out))
    return spark.read.parquet(out)


def _before(*order: str, by: list[str] | None = None):
    return (Window.partitionBy(*(by or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))


def prefix(ranges: DataFrame, **sums: str) -> DataFrame:
    """Ranges with, for each ``name=column``, the sum of the column over the ranges before in their file."""
    return ranges.select("*", *(F.coalesce(F.sum(c).over(_before("block", by=["file"])), F.lit(0)).alias(n) for n, c in sums.items()))


def file_offsets(ranges: DataFrame, count: str) -> DataFrame:
    """``(file, offset)``: the sum of ``count`` over all files before, by name (a row a file)."""
    files = ranges.groupBy("file").agg(F.sum(count).alias("n"))
    return files.select("file", F.coalesce(F.sum("n").over(_before("file")), F.lit(0)).alias("offset"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line bigint, value string)``: the lines of all files under ``path``, numbered 0..n-1 by file name
    and place.  Only counts of ranges are put in order; no line is shuffled.  The numbers are the same
    however the files are cut into ranges."""
    rows = pieces(spark, path)
    ranges = rows.groupBy(*_RANGE).agg(F.min("id").alias("first"), F.count("*").alias("n"))
    ranges = prefix(ranges, before="n").join(file_offsets(ranges, "n"), "file")
    ranges = ranges.select(*_RANGE, (F.col("offset") + F.col("before") - F.col("first")).alias("shift"))
    return rows.join(F.broadcast(ranges), _RANGE).select((F.col("id") + F.col("shift")).alias("line"), "value")


_LINES = "file string, block bigint, id bigint, value string, odd int, inside int, starts0 bigint, starts1 bigint"


def _running(batches):
    """Lines with ``inside``, the parity of the quotes before them in their range, and ``starts0``, ``starts1``, the
    records that start in the range up to them if it starts outside or inside quotes.  Ranges come
    whole and in order, so three numbers are carried from batch to batch."""
    now, sums = None, (0, 0, 0)
    for batch in batches:
        if not batch.num_rows:
            continue
        odd, line = batch.column("odd").to_numpy().astype(np.int64), ~batch.column("blank").to_numpy(zero_copy_only=False)
        file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        new = np.flatnonzero((np.diff(file.indices.to_numpy()) != 0) | (np.diff(block) != 0)) + 1
        columns = ([], [], [])
        for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
            key = (file[a].as_py(), int(block[a]))
            if key != now:
                now, sums = key, (0, 0, 0)
            quotes = sums[0] + np.cumsum(odd[a:b])
            inside = (quotes - odd[a:b]) % 2
            starts = [sums[k + 1] + np.cumsum((inside == k) & line[a:b]) for k in (0, 1)]
            sums = (int(quotes[-1]), int(starts[0][-1]), int(starts[1][-1]))
            for column, part in zip(columns, (inside, *starts)):
                column.append(part)
        inside, *starts = map(np.concatenate, columns)
        kept = [batch.column(c) for c in ("file", "block", "id", "value", "odd")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(inside.astype(np.int32)), *(pa.array(x.astype(np.int64)) for x in starts)],
                                         ["file", "block", "id", "value", "odd", "inside", "starts0", "starts1"])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(row bigint, record string)``: the records of CSV files whose quotes stand around fields and are
    doubled inside, numbered 0..n-1 by file name and place without each file's first, its header,
    whose ``row`` is null.  Blank lines between records count for nothing.

    A line break ends a record if the quotes before it in the file are even in number.  Each range counts
    its quotes, and its records if it starts outside or inside quotes, as its lines are read; they are
    written once, with these counts.  Prefixes over ranges, which are broadcast, say which holds.  Lines
    of records that span several are gathered by (file, record), the only shuffle of text; the others stay."""
    ship_package(spark)
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2
    out = scratch_path(spark, "lines")
    (spark.read.option("lineSep", "\n").text(path)
     .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
             F.monotonically_increasing_id().alias("id"), "value", odd.cast("int").alias("odd"),
             F.col("value").rlike(r"^[ \t\r]*$").alias("blank"))
     .mapInArrow(_running, _LINES).write.parquet(out))
    rows = spark.read.parquet(out)
    ranges = rows.groupBy(*_RANGE).agg(F.sum("odd").alias("odds"), F.max("starts0").alias("n0"), F.max("starts1").alias("n1"))
    ranges = prefix(ranges, odds_before="odds").withColumn("state", F.col("odds_before") % 2)
    ranges = ranges.withColumn("n", F.when(F.col("state") == 0, F.col("n0")).otherwise(F.col("n1")))
    # files without a record have no header; others have one record that is no row
    per_file = ranges.groupBy("file").agg(F.greatest(F.sum("n") - 1, F.lit(0)).alias("n"))
    offsets = per_file.select("file", F.coalesce(F.sum("n").over(_before("file")), F.lit(0)).alias("offset"),
                              F.row_number().over(Window.orderBy("file")).alias("number"))
    # a row a range: small beside the lines, which stay where they are
    ranges = prefix(ranges, records_before="n").join(offsets, "file").select(*_RANGE, "state", "records_before", "offset", "number")
    rows = rows.join(F.broadcast(ranges), _RANGE)
    inside = (F.col("inside") + F.col("state")) % 2 == 1
    record = F.col("records_before") + F.when(F.col("state") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    rows = rows.where(inside | ~F.col("value").rlike(r"^[ \t\r]*$")).select("number", "block", "id", "value", "offset", record.alias("record"),
                                                                           (~inside & (F.col("odd") == 0)).alias("whole"))
    whole = rows.where("whole").select("number", "record", "offset", "value")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("block", "id", "value"))), lambda x: x["value"])
    spread = rows.where("NOT whole").groupBy("number", "record").agg(F.any_value("offset").alias("offset"), F.array_join(lines, "\n").alias("value"))
    records = whole.unionByName(spread).withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    text = F.when(F.col("record") == 1, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    row = F.when(F.col("record") > 1, F.col("offset") + F.col("record") - 2)
    return records.select(row.alias("row"), text.alias("record"))


def _depth(text: Column) -> Column:
    """Opening minus closing brackets of a text without strings."""
    only = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]", ""))
    return only(r"\[{") - only(r"\]}")


def json_array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``(element bigint, value variant)``: the elements of JSON files that hold one array each, numbered
    0..n-1 by file name and place.  A file that is no array raises ValueError.

    Files are cut at every ``}``, so arrays on one line are split too.  A piece says whether it changes
    the string state (its quotes without escaped ones) and how it changes the depth if it starts
    outside or inside a string; prefixes over ranges give both at each piece.  Where the depth is
    back at 1 outside a string an element ends, and the text since the last one, as an array of its
    own, goes to the JSON reader: other elements than objects ride along with the next object."""
    plain = F.regexp_replace(F.concat("value", F.lit("}")), r"(?s)\\.", "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"')))
    no_strings = lambda t: F.regexp_replace(t, r'"[^"]*("|$)', "")
    rest = F.when(F.contains(plain, F.lit('"')), F.regexp_replace(plain, r'^[^"]*"', "")).otherwise(F.lit(""))
    rows = pieces(spark, path, "}", flip=quotes % 2, deep0=_depth(no_strings(plain)), deep1=_depth(no_strings(rest)))
    # the last piece of a file ends with the file and not with a bracket
    last = Window.partitionBy("file").orderBy(F.desc("block"), F.desc("id"))
    tails = (rows.groupBy(*_RANGE).agg(F.max("id").alias("id")).withColumn("k", F.row_number().over(last)).where("k = 1")
             .select("file", "block", "id", F.lit(1).alias("tail")))
    rows = rows.join(F.broadcast(tails), [*_RANGE, "id"], "left").withColumn("tail", F.coalesce("tail", F.lit(0)))
    back = _before("id", by=_RANGE)
    upto = Window.partitionBy(*_RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("inside", F.coalesce(F.sum("flip").over(back), F.lit(0)) % 2)
    for state in (0, 1):
        # a tail has no bracket of its own
        step = F.when(F.col("inside") == state, F.col("deep0") + F.col("tail")).otherwise(F.col("deep1") + F.when(F.col("flip") == 1, F.col("tail")).otherwise(0))
        rows = rows.withColumn(f"depth{state}", F.sum(step).over(upto))
    out = scratch_path(spark, "array")
    rows.write.parquet(out)
    rows = spark.read.parquet(out)
    end = lambda c: F.max_by(c, "id")
    ranges = rows.groupBy(*_RANGE).agg(F.sum("flip").alias("flips"), end("depth0").alias("d0"), end("depth1").alias("d1"))
    ranges = prefix(ranges, flips_before="flips").withColumn("state", F.col("flips_before") % 2)
    ranges = ranges.withColumn("d", F.when(F.col("state") == 0, F.col("d0")).otherwise(F.col("d1")))
    ranges = prefix(ranges, depth_before="d")
    wrong = ranges.groupBy("file").agg(F.sum("flips").alias("flips"), F.sum("d").alias("d")).where("flips % 2 = 1 OR d <> 0").limit(1).collect()
    if wrong:
        raise ValueError(f"{wrong[0].file} is no JSON array: " + ("a string" if wrong[0].flips % 2 else "a bracket") + " has no end")
    rows = rows.join(F.broadcast(ranges.select(*_RANGE, "state", "depth_before")), _RANGE)
    depth = F.col("depth_before") + F.when(F.col("state") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    outside = (F.col("inside") + F.col("state") + F.col("flip")) % 2 == 0
    rows = rows.withColumn("ends", ((depth == 1) & outside & (F.col("tail") == 0)).cast("int"))
    rows = rows.withColumn("done", F.coalesce(F.sum("ends").over(back), F.lit(0)))
    counts = prefix(rows.groupBy(*_RANGE).agg(F.sum("ends").alias("n")), ends_before="n").select(*_RANGE, "ends_before")
    rows = rows.join(F.broadcast(counts), _RANGE).withColumn("part", F.col("ends_before") + F.col("done"))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "id", "value", "tail"))),
                        lambda x: F.concat(x["value"], F.when(x["tail"] == 0, F.lit("}")).otherwise(F.lit(""))))
    parts = rows.groupBy("file", "part").agg(F.array_join(texts, "").alias("text"), F.max("tail").alias("tail"))
    # off go the array's own brackets, and the comma after the element before
    blank = r"[\x20\t\r\n]*"
    first, ending = F.col("part") == 0, F.col("tail") == 1
    text = F.regexp_replace("text", "^\ufeff", "")
    opened = ~first | text.rlike(rf"^{blank}\[")
    closed = ~ending | text.rlike(rf"\]{blank}\z")
    body = F.when(first, F.regexp_replace(text, rf"^{blank}\[", "")).otherwise(text)
    body = F.when(ending, F.regexp_replace(body, rf"\]{blank}\z", "")).otherwise(body)
    comma = ~first & body.rlike(rf"^{blank},")
    joined = first | comma | body.rlike(rf"^{blank}\z")          # after an element: a comma, or nothing
    body = F.when(comma, F.regexp_replace(body, rf"^{blank},", "")).otherwise(body)
    empty = body.rlike(rf"^{blank}\z")
    parsed = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<variant>", _STRICT)
    good = opened & closed & joined & (empty | parsed.isNotNull()) & ~(comma & empty)
    fault = F.raise_error(F.concat(F.lit("no JSON array: "), F.col("file"))).cast("array<variant>")
    items = F.when(~good, fault).when(~empty, parsed)
    out = scratch_path(spark, "elements")
    (parts.select("file", "part", items.alias("items")).where(F.col("items").isNotNull())
     .select("file", "part", F.posexplode("items").alias("place", "value")).write.parquet(out))
    rows = spark.read.parquet(out)
    return _number_parts(rows)


def _number_parts(rows: DataFrame) -> DataFrame:
    """``(element, value)``: numbers by file, part and place, from counts of runs of parts."""
    run = F.shiftright("part", 12).alias("block")
    ranges = rows.groupBy("file", run).agg(F.count("*").alias("n"))
    ranges = prefix(ranges, before="n").join(file_offsets(ranges, "n"), "file").select(*_RANGE, (F.col("offset") + F.col("before")).alias("shift"))
    order = Window.partitionBy("file", "block").orderBy("part", "place")
    return (rows.withColumn("block", F.shiftright("part", 12)).withColumn("k", F.row_number().over(order))
            .join(ranges, _RANGE).select((F.col("shift") + F.col("k") - 1).alias("element"), "value"))
