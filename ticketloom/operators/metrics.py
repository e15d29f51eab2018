"""Evaluation metrics (A9-A15, A18, JN3, T7, T8).

Every metric derives from one grouped (true, pred) count table of at most
labels^2 rows, computed with partial aggregation; no label list is held in
memory per row and nothing but that small table is ever re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.fixed_values import FIELD_ACCURACY_ORDER
from ticketloom.functions import jsonx
from ticketloom.operators.responses import MATCH_COLUMNS

def pair_counts(labels: DataFrame, t: str = "true_label", p: str = "pred_label") -> DataFrame:
    return labels.groupBy(F.col(t).alias("t"), F.col(p).alias("p")).agg(F.count("*").alias("n"))


def overall_accuracy(labels: DataFrame) -> DataFrame:
    """Share of rows with true == pred (null for an empty table)."""
    eq = F.col("true_label").eqNullSafe(F.col("pred_label")).cast("int")
    return labels.agg(F.count("*").alias("n_samples"), F.round(F.avg(eq), 6).alias("accuracy"))


def class_metrics(labels: DataFrame) -> DataFrame:
    """A10: per label (union of true and predicted) precision, recall, F1
    and support; 0 where undefined."""
    pc = pair_counts(labels)
    by_true = pc.groupBy(F.col("t").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("t").eqNullSafe(F.col("p")), F.col("n"))).alias("tp"))
    by_pred = pc.groupBy(F.col("p").alias("_plabel")).agg(F.sum("n").alias("predicted"))
    # null-safe: a null label (a JSON null type) is one label, not two
    m = by_true.join(by_pred, by_true["label"].eqNullSafe(by_pred["_plabel"]), "full_outer")
    m = m.withColumn("label", F.coalesce(F.col("label"), F.col("_plabel")))
    tp = F.coalesce(F.col("tp"), F.lit(0))
    sup = F.coalesce(F.col("support"), F.lit(0))
    pr = F.coalesce(F.col("predicted"), F.lit(0))
    precision = F.when(pr > 0, tp / pr).otherwise(F.lit(0.0))
    recall = F.when(sup > 0, tp / sup).otherwise(F.lit(0.0))
    m = m.select("label", precision.alias("p"), recall.alias("r"), sup.cast("bigint").alias("support"))
    f1 = F.when(F.col("p") + F.col("r") > 0,
                2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(F.lit(0.0))
    return m.select("label", F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"),
                    F.round(f1, 6).alias("f1"), "support")


def avg_metrics(per_class: DataFrame) -> DataFrame:
    """Macro (plain mean over labels) and weighted (by support)."""
    s = F.col("support")
    macro = per_class.agg(F.lit("macro avg").alias("average"),
                          F.round(F.avg("precision"), 6).alias("precision"),
                          F.round(F.avg("recall"), 6).alias("recall"),
                          F.round(F.avg("f1"), 6).alias("f1"), F.sum(s).cast("bigint").alias("support"))
    wsum = lambda c: F.round(F.when(F.sum(s) > 0, F.sum(F.col(c) * s) / F.sum(s)), 6)
    weighted = per_class.agg(F.lit("weighted avg").alias("average"), wsum("precision").alias("precision"),
                             wsum("recall").alias("recall"), wsum("f1").alias("f1"),
                             F.sum(s).cast("bigint").alias("support"))
    return macro.unionByName(weighted)


def label_set(labels: DataFrame) -> DataFrame:
    """The distinct union of true and predicted labels, from the pair
    counts (one pass).  Labels are open-ended, so they are put in order only
    where a report is printed."""
    return pair_counts(labels).select(F.explode(F.array("t", "p")).alias("label")).distinct()


def confusion_matrix(labels: DataFrame) -> DataFrame:
    """A12/JN3: the non-zero (true_label, pred_label, n) cells, whatever the
    number of labels; the axes are ``label_set``, and ``dense_matrix``
    (plans.reports) fills in the zeros when a matrix is printed."""
    return pair_counts(labels, "true_label", "pred_label").select(
        F.col("t").alias("true_label"), F.col("p").alias("pred_label"), "n")


AXIS_BLOCK = 1000


def dense_grid(labels: DataFrame, block: int = AXIS_BLOCK) -> DataFrame:
    """JN3: every cell of the confusion matrix with its zeros, as blocks ``(true_label, axis, pred_labels,
    counts)``: the axis of predicted labels is dealt by hash into pieces of about ``block`` labels,
    and a matrix row has one block for each, with its labels in order and a count for each.  The
    axes are the labels of both sides (null is one); no label list leaves the executors and no block
    is longer than a piece, however many labels there are."""
    counts = pair_counts(labels).checkpoint(eager=True)
    axis = counts.select(F.explode(F.array("t", "p")).alias("label")).distinct().checkpoint(eager=True)
    pieces = max(1, -(-axis.count() // block))
    piece = lambda c: F.pmod(F.xxhash64(c), F.lit(pieces)).cast("int")
    # nulls and texts alike as structs, as a list leaves out nulls
    lists = (axis.groupBy(piece("label").alias("axis"))
             .agg(F.sort_array(F.collect_list(F.struct("label"))).alias("pred_labels")))
    cells = (counts.groupBy("t", piece("p").alias("axis"))
             .agg(F.collect_list(F.struct(F.col("p").alias("label"), "n")).alias("cells")))
    rows = axis.select(F.col("label").alias("true_label"), F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("axis")).join(lists, "axis")
    full = rows.join(cells, rows["true_label"].eqNullSafe(cells["t"]) & (rows["axis"] == cells["axis"]), "left")
    # a cell's label is looked up in a map; a null label has a key that no text has
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    known = F.map_from_entries(F.transform("cells", lambda c: F.struct(key(c["label"]).alias("key"), c["n"].alias("value"))))
    found = F.transform("pred_labels", lambda x: F.coalesce(F.try_element_at(known, key(x["label"])), F.lit(0)).cast("bigint"))
    return full.select("true_label", rows["axis"], F.transform("pred_labels", lambda x: x["label"]).alias("pred_labels"), found.alias("counts"))


def field_accuracy(detailed: DataFrame) -> DataFrame:
    """Among type-correct compared rows, matches / relevant per field;
    fields with no relevant row are left out."""
    correct = detailed.where(F.col("type_correct"))
    stack = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(i).alias("ord"),
                                         F.col(c).alias("m"))
                                for i, (f, c) in enumerate(zip(FIELD_ACCURACY_ORDER, MATCH_COLUMNS))]))
    long = correct.select(stack.alias("x")).select("x.field", "x.ord", "x.m").where(F.col("m").isNotNull())
    return long.groupBy("field", "ord").agg(F.round(F.avg(F.col("m").cast("int")), 6).alias("accuracy"))


def error_rates(labels: DataFrame) -> DataFrame:
    """Parse and domain error counts and rates (null when empty),
    by the branch that the comparison took: a reply whose ticket type reads
    "error" is no parse error."""
    n = F.count("*")
    pe = F.count_if(F.col("outcome") == "pred_error")
    de = F.count_if(F.col("outcome") == "domain_error")
    return labels.agg(n.alias("n_samples"), pe.alias("parse_errors"), de.alias("domain_errors"),
                      F.round(F.when(n > 0, pe / n), 6).alias("parse_error_rate"),
                      F.round(F.when(n > 0, de / n), 6).alias("domain_error_rate"))


def error_shares(labels: DataFrame) -> DataFrame:
    """The error pie: Correct = 1 - both rates (it includes wrong types)."""
    r = error_rates(labels)
    parts = F.array(
        F.struct(F.lit("Correct").alias("part"),
                 F.round(F.lit(1.0) - F.col("parse_error_rate") - F.col("domain_error_rate"), 6).alias("share")),
        F.struct(F.lit("Parse Errors").alias("part"), F.col("parse_error_rate").alias("share")),
        F.struct(F.lit("Domain Errors").alias("part"), F.col("domain_error_rate").alias("share")))
    return r.select(F.explode(parts).alias("x")).select("x.part", "x.share")


def sample_predictions(detailed: DataFrame, k: int = 3) -> DataFrame:
    """First k correct and first k incorrect compared rows by sample_id
    (row_number <= k per flag; planned as a WindowGroupLimit)."""
    w = Window.partitionBy("type_correct").orderBy("sample_id")
    shown = lambda m: jsonx.get_or(m, "ticket_type", "N/A")          # what the report prints
    return (detailed.where(F.col("type_correct").isNotNull())
            .withColumn("ord", F.row_number().over(w)).where(F.col("ord") <= k)
            .select("type_correct", F.col("ord").cast("bigint").alias("ord"), "sample_id", "user_input",
                    "true_label", "pred_label", shown("truth").alias("true_type"), shown("pred").alias("pred_type")))


def eval_report(labels: DataFrame) -> DataFrame:
    """K4: the evaluation report as a long table (section, key, metric,
    value); text is rendered from it on the driver (plans.reports)."""
    acc = overall_accuracy(labels)
    cm = class_metrics(labels)
    overall = acc.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").cast("double").alias("value")),
        F.struct(F.lit("total_samples").alias("metric"), F.col("n_samples").cast("double").alias("value")),
    )).alias("x")).select(F.lit("overall").alias("section"), F.lit("all").alias("key"), "x.metric", "x.value")
    per_class = cm.select("label", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1", "support")])).alias("x")).select(
        F.lit("class").alias("section"), F.col("label").alias("key"), "x.metric", "x.value")
    macro = avg_metrics(cm).where(F.col("average") == "macro avg").select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1")])).alias("x")).select(
        F.lit("macro").alias("section"), F.lit("macro avg").alias("key"), "x.metric", "x.value")
    fields = field_accuracy(labels).select(F.lit("field").alias("section"), F.col("field").alias("key"),
                                           F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    rates = error_rates(labels).select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("parse_error_rate", "domain_error_rate")])).alias("x")).select(
        F.lit("errors").alias("section"), F.lit("all").alias("key"), "x.metric", "x.value")
    return overall.unionByName(per_class).unionByName(macro).unionByName(fields).unionByName(rates)


def eval_summary(labels: DataFrame) -> DataFrame:
    """K6: the console summary as (metric, value) rows."""
    acc = overall_accuracy(labels).select(F.lit("overall_accuracy").alias("metric"),
                                          F.col("accuracy").alias("value"))
    rates = error_rates(labels).select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
        for m in ("parse_error_rate", "domain_error_rate")])).alias("x")).select("x.metric", "x.value")
    fields = field_accuracy(labels).select(F.concat(F.lit("field:"), F.col("field")).alias("metric"),
                                           F.col("accuracy").alias("value"))
    return acc.unionByName(rates).unionByName(fields)
