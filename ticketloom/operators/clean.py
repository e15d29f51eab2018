"""Parsing and canonicalising raw tickets (P1-P6, JN1, F1, F3-F5).

All steps are narrow projections/filters over ``raw_tickets``: no shuffle.
The JSON parse runs in a generator (variant values and lambda functions are
interpreted, not code-generated); the projections around it are built-in
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.fixed_values import (
    COMMUNICATION_NOT_SPECIFIED, COMMUNICATION_REPLACEMENT, CSV_NULL_SPELLINGS,
    HIGH_SEVERITIES, RAW_KEYS, SEVERITY_DEFAULT, SEVERITY_MAPPING, SHORT_INPUT_CHARS,
    STANDARD_TYPES, TICKET_TYPE_DEFAULT, TICKET_TYPE_MAPPING)
from ticketloom.functions import jsonx
from ticketloom.functions.text import contains_ci, py_strip

# raw key -> column name of the parsed frame
RAW_COLUMNS = {k: k.lower().replace(" ", "_") for k in RAW_KEYS}


def literal_map(d: dict) -> Column:
    """A constant MAP<STRING,STRING> (folded by Catalyst)."""
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def with_parsed(raw: DataFrame, col: str = "output") -> DataFrame:
    """Adds ``obj`` (map<string,variant>, null unless a JSON object)."""
    return jsonx.with_object(raw, F.col(col), "obj")


def keep_parsed(raw: DataFrame, col: str = "output") -> DataFrame:
    """Rows whose ``col`` is a JSON object, with ``obj`` added; each JSON
    text is parsed once (generator outputs, so the filter is not pushed
    below the parse)."""
    return jsonx.with_object(raw, F.col(col), "obj", only_valid=True)


def parse_counts(raw: DataFrame) -> DataFrame:
    """One row: parsed, parse_errors."""
    ok = F.col("obj").isNotNull()
    return with_parsed(raw).agg(F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("parse_errors"))


def parse_tickets(raw: DataFrame) -> DataFrame:
    """Rows whose output is a JSON object, with every known key as raw text
    (JSON null and absence both null) plus ``obj`` for type tests and its
    text ``obj_text`` (P1, P3)."""
    p = keep_parsed(raw)
    cols = [F.col("row_index"), F.col("input").alias("original_input"), F.col("obj"), F.col("output").alias("obj_text")]
    cols += [jsonx.as_text(jsonx.value("obj", k)).alias(c) for k, c in RAW_COLUMNS.items()]
    return p.select(*cols)


def discover_keys(parsed: DataFrame) -> DataFrame:
    """Distinct keys over all objects with the number of objects holding
    them; partial aggregation before the shuffle (P3)."""
    return (parsed.select(F.explode(F.map_keys("obj")).alias("key"))
            .groupBy("key").agg(F.count("*").alias("n_rows")))


def _lower_strip_string(m: str, key: str) -> Column:
    """``.str.lower().str.strip()`` on a pandas object column: non-strings
    become null."""
    return py_strip(F.lower(jsonx.as_string(jsonx.value(m, key))))


def canonical_type(m: str = "obj") -> Column:
    return F.coalesce(F.try_element_at(literal_map(TICKET_TYPE_MAPPING),
                                       _lower_strip_string(m, "Ticket Type")),
                      F.lit(TICKET_TYPE_DEFAULT))


def canonical_severity(m: str = "obj") -> Column:
    return F.coalesce(F.try_element_at(literal_map(SEVERITY_MAPPING),
                                       _lower_strip_string(m, "Severity")),
                      F.lit(SEVERITY_DEFAULT))


def canonical_communication(m: str = "obj") -> Column:
    c = _lower_strip_string(m, "Preferred Communication")
    return F.when(c == COMMUNICATION_NOT_SPECIFIED, F.lit(COMMUNICATION_REPLACEMENT)).otherwise(c)


def clean_tickets(parsed: DataFrame) -> DataFrame:
    """Canonical type, severity and communication; other keys as text."""
    return (parsed
            .withColumn("ticket_type", canonical_type())
            .withColumn("severity", canonical_severity())
            .withColumn("preferred_communication", canonical_communication()))


def clean_by_lookup(df: DataFrame, key: Column, mapping: DataFrame, default: str,
                    out: str) -> DataFrame:
    """JN1 with a user's mapping table (columns ``src``, ``dst``): left join on
    the normalised key, default when unmapped.  Spark picks the join by the
    mapping's size in bytes."""
    m = mapping.select(F.col("src").alias("_src"), F.col("dst").alias("_dst"))
    j = df.withColumn("_key", key).join(m, F.col("_key") == F.col("_src"), "left")
    return j.withColumn(out, F.coalesce(F.col("_dst"), F.lit(default))).drop("_key", "_src", "_dst")


def mapping_frame(spark: SparkSession, d: dict) -> DataFrame:
    return spark.createDataFrame(list(d.items()), "src string, dst string")


def assistance_tickets(parsed: DataFrame) -> DataFrame:
    """raw type contains 'assistance' (any case); non-strings are false."""
    t = jsonx.as_string(jsonx.value("obj", "Ticket Type"))
    return parsed.where(contains_ci(t, "assistance")).select("row_index", "ticket_type")


def high_severity(clean: DataFrame) -> DataFrame:
    """cleaned severity in (high, critical)."""
    return clean.where(F.col("severity").isin(HIGH_SEVERITIES)).select("row_index", "severity")


def non_standard_types(df: DataFrame, col: str = "ticket_type") -> DataFrame:
    """value not in the standard list; null counts as non-standard."""
    std = F.coalesce(F.col(col).isin(STANDARD_TYPES), F.lit(False))
    return df.where(~std).select("row_index", F.col(col).alias("ticket_type"))


def very_short_inputs(df: DataFrame, col: str = "original_input") -> DataFrame:
    """inputs shorter than 10 code points."""
    n = F.length(col)
    return df.where(n < SHORT_INPUT_CHARS).select("row_index", n.cast("bigint").alias("n_chars"))


def csv_nulls(df: DataFrame, *cols: str) -> DataFrame:
    """pandas' read_csv null spellings -> null, after a CSV scan."""
    for c in cols:
        df = df.withColumn(c, F.when(~F.coalesce(F.col(c).isin(CSV_NULL_SPELLINGS), F.lit(False)),
                                     F.col(c)))
    return df
