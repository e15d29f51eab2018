"""Model replies -> tickets -> outcome labels (E1-E4, JN2).

Pure column expressions: the reply tail after the last ``[/INST]``, the
greedy ``{...}`` block, the strict JSON parse and the four-way outcome
rule all run inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.fixed_values import (
    COMPARED_FIELDS, LABEL_DOMAIN_ERROR, LABEL_ERROR, LABEL_JSON_ERROR, LABEL_OUT_OF_DOMAIN,
    LABEL_PARSE_ERROR, LABEL_UNKNOWN, REPLY_BAD_JSON_PREFIX, REPLY_NO_JSON_ERROR)
from ticketloom.functions import jsonx
from ticketloom.functions.json_errors import error_text, first_error
from ticketloom.functions.text import json_block, reply_tail


def parse_replies(df: DataFrame, response: str = "response") -> DataFrame:
    """Adds ``pred`` (map<string,variant> of the reply's JSON object),
    ``status`` ('ok', 'no_json', 'bad_json'), ``raw`` (the reply tail when
    parsing failed) and ``pred_has_error``.  ``pred_error`` of bad JSON is
    the decoder's own message with its line, column and character."""
    out = jsonx.materialize(df, _tail=reply_tail(F.col(response)))
    out = jsonx.materialize(out, _block=json_block(F.col("_tail")))
    out = jsonx.with_object(out, F.col("_block"), "pred")
    status = (F.when(F.col("_block").isNull(), F.lit("no_json"))
              .when(F.col("pred").isNull(), F.lit("bad_json")).otherwise(F.lit("ok")))
    out = jsonx.materialize(out, status=status)
    # only texts that are no JSON are gone through (a JSON value that is no object has no message)
    out = jsonx.materialize(out, _fault=F.when(F.col("status") == "bad_json", first_error(F.col("_block"))))
    message = F.coalesce(error_text(F.col("_block"), F.col("_fault")), F.lit(""))
    err = (F.when(F.col("status") == "no_json", F.lit(REPLY_NO_JSON_ERROR))
           .when(F.col("status") == "bad_json", F.concat(F.lit(REPLY_BAD_JSON_PREFIX), message))
           .otherwise(jsonx.as_text(jsonx.value("pred", "error"))))
    return (out.withColumn("pred_error", err)
            .withColumn("pred_has_error", (F.col("status") != "ok") | jsonx.has_key("pred", "error"))
            .withColumn("raw", F.when(F.col("status") != "ok", F.col("_tail")))
            .drop("_tail", "_block", "_fault"))


def quick_labels(df: DataFrame, response: str = "response", truth: str = "true_json") -> DataFrame:
    """The training script's quick check.  Rows whose truth is an error
    ticket are skipped (F8); no JSON -> {} -> 'parse_error'; bad JSON ->
    'json_error'; otherwise the reply's ticket_type or 'parse_error'."""
    p = jsonx.with_object(parse_replies(df, response), F.col(truth), "_t")
    pred = (F.when(F.col("status") == "no_json", F.lit(LABEL_PARSE_ERROR))
            .when(F.col("status") == "bad_json", F.lit(LABEL_JSON_ERROR))
            .otherwise(jsonx.get_or("pred", "ticket_type", LABEL_PARSE_ERROR)))
    return (p.where(~jsonx.has_key("_t", "error"))
            .select("sample_id", jsonx.as_text(jsonx.value("_t", "ticket_type")).alias("true_label"),
                    pred.alias("pred_label")))


def join_predictions(truth: DataFrame, predictions: DataFrame, on: str = "sample_id") -> DataFrame:
    """JN2: truth rows with their replies.  Every truth row is evaluated: one
    without a prediction has a null reply (counted as unparsable); a
    prediction without a truth row has nothing to compare with and is left
    out."""
    return truth.join(predictions, on, "left")


def pair_by_position(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """JN2 without a key: line k of the truth with line k of the predictions, as two parallel lists are read.
    Both are ``splitting.numbered_lines`` (``line``, ``value``); gives ``(sample_id, truth_line,
    prediction_line)``.  Every truth line stays: beyond the end of the predictions its prediction is
    null (an unparsable reply); predictions beyond the end of the truth are left out."""
    lines = predictions.select("line", F.col("value").alias("prediction_line"))
    return (truth.join(lines, "line", "left")
            .select(F.col("line").alias("sample_id"), F.col("value").alias("truth_line"), "prediction_line"))


def outcomes(df: DataFrame, response: str = "response", truth: str = "true_json") -> DataFrame:
    """E3 (+E1): adds ``truth`` map, ``true_label``, ``pred_label``,
    ``outcome`` and the E4 comparison columns.

    pred error, truth fine  -> ('error', truth type or 'unknown')
    both error              -> ('out_of_domain', 'out_of_domain')
    neither                 -> (pred type or 'unknown', truth type or 'unknown')
    pred fine, truth error  -> ('domain_error', truth type or 'out_of_domain')
    A model's own refusal counts as 'error' when the truth is a ticket; the
    ``status`` column keeps parse failures and refusals apart."""
    p = jsonx.with_object(parse_replies(df, response), F.col(truth), "truth")
    te, pe = jsonx.has_key("truth", "error"), F.col("pred_has_error")
    t_type = lambda d: jsonx.get_or("truth", "ticket_type", d)
    outcome = (F.when(pe & ~te, F.lit("pred_error")).when(te & pe, F.lit("both_error"))
               .when(~te & ~pe, F.lit("compared")).otherwise(F.lit("domain_error")))
    p = jsonx.materialize(p, outcome=outcome)
    o = F.col("outcome")
    pred_label = (F.when(o == "pred_error", F.lit(LABEL_ERROR))
                  .when(o == "both_error", F.lit(LABEL_OUT_OF_DOMAIN))
                  .when(o == "compared", jsonx.get_or("pred", "ticket_type", LABEL_UNKNOWN))
                  .otherwise(F.lit(LABEL_DOMAIN_ERROR)))
    true_label = (F.when(o == "pred_error", t_type(LABEL_UNKNOWN))
                  .when(o == "both_error", F.lit(LABEL_OUT_OF_DOMAIN))
                  .when(o == "compared", t_type(LABEL_UNKNOWN))
                  .otherwise(t_type(LABEL_OUT_OF_DOMAIN)))
    p = jsonx.materialize(p, true_label=true_label, pred_label=pred_label)
    return add_field_matches(p)


def _field_equal(f: str) -> Column:
    """``true.get(f) == pred.get(f)`` on JSON values (both missing or
    null -> equal; 3 != "3")."""
    a = jsonx.json_text(jsonx.value("truth", f))
    b = jsonx.json_text(jsonx.value("pred", f))
    return a.eqNullSafe(b)


def _type_equal() -> Column:
    """J6 on the ticket types, the default standing for an absent key."""
    unknown = F.lit(f'"{LABEL_UNKNOWN}"')
    of = lambda m: F.when(jsonx.has_key(m, "ticket_type"), jsonx.json_text(jsonx.value(m, "ticket_type"))).otherwise(unknown)
    return of("truth").eqNullSafe(of("pred"))


def add_field_matches(p: DataFrame) -> DataFrame:
    """For compared rows: type_correct, one match column per field,
    ``assistance_request_match`` only when the true type is 'assistance'
    (present and non-null in the reply)."""
    cmp_ = F.col("outcome") == "compared"
    p = p.withColumn("type_correct", F.when(cmp_, _type_equal()))
    for f in COMPARED_FIELDS:
        p = p.withColumn(f"{f}_match", F.when(cmp_, _field_equal(f)))
    ar = jsonx.present_non_null("pred", "assistance_request")
    return p.withColumn("assistance_request_match",
                        F.when(cmp_ & (F.col("true_label") == "assistance"), ar))


MATCH_COLUMNS = [f"{f}_match" for f in COMPARED_FIELDS] + ["assistance_request_match"]
