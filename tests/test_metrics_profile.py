"""Metrics edge cases, histogram against numpy, report rendering."""

from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from ticketloom.operators import metrics as MT
from ticketloom.operators import profile as PR
from ticketloom.operators import responses as RS
from ticketloom.plans.reports import dense_matrix, render_eval_report, render_quality_report


def _labels(spark, pairs):
    return spark.createDataFrame(pairs, "true_label string, pred_label string")


def test_label_never_predicted_and_only_predicted(spark):
    lab = _labels(spark, [("a", "a"), ("a", "b"), ("c", "a"), ("c", "c")])
    m = {r.label: r for r in MT.class_metrics(lab).collect()}
    assert set(m) == {"a", "b", "c"}
    assert (m["b"].precision, m["b"].recall, m["b"].f1, m["b"].support) == (0.0, 0.0, 0.0, 0)
    assert m["a"].precision == 0.5 and m["a"].recall == 0.5
    acc = MT.overall_accuracy(lab).first()
    assert acc.accuracy == 0.5
    w = {r.average: r for r in MT.avg_metrics(MT.class_metrics(lab)).collect()}
    assert abs(w["weighted avg"].recall - acc.accuracy) < 1e-9   # weighted recall = accuracy


def test_empty_metrics(spark):
    lab = _labels(spark, []).withColumn("outcome", F.lit("compared"))
    assert MT.class_metrics(lab).count() == 0
    r = MT.error_rates(lab).first()
    assert r.n_samples == 0 and r.parse_error_rate is None
    assert MT.overall_accuracy(lab).first().accuracy is None


def test_confusion_total_equals_rows(spark):
    lab = _labels(spark, [("a", "a"), ("a", "b"), ("c", "a"), ("c", "c"), ("b", "b")])
    cm = MT.confusion_matrix(lab)
    assert cm.count() == 5
    assert cm.agg(F.sum("n")).first()[0] == 5


def test_confusion_cells_are_of_one_kind_at_every_size(spark):
    """1,000 and 1,001 labels: the non-zero cells, no zeros, no grid."""
    for n in (1000, 1001):
        lab = spark.range(n).select(F.concat(F.lit("l"), "id").alias("true_label"), F.lit("l0").alias("pred_label"))
        cm = MT.confusion_matrix(lab)
        assert cm.count() == n and cm.where("n = 0").isEmpty()
        assert MT.label_set(lab).count() == n


def test_dense_matrix_fills_zeros():
    axis, m = dense_matrix([dict(true_label="a", pred_label="b", n=2), dict(true_label="b", pred_label="b", n=1)], ["b", "a"])
    assert axis == ["a", "b"] and m == [[0, 2], [0, 1]]


def test_errors_are_counted_by_outcome_not_by_label(spark):
    """A reply whose type reads "error" or "domain_error" is compared, and wrong; it is no error."""
    truth = '{"ticket_type": "inquiry"}'
    rows = [(1, truth, '{"ticket_type": "error"}'), (2, truth, '{"ticket_type": "domain_error"}'),
            (3, truth, "no json"), (4, '{"error": "x"}', '{"ticket_type": "inquiry"}')]
    e = RS.outcomes(spark.createDataFrame(rows, "sample_id long, true_json string, response string"))
    r = MT.error_rates(e).first()
    assert (r.n_samples, r.parse_errors, r.domain_errors) == (4, 1, 1)


def test_ticket_types_compare_as_json_values(spark):
    rows = [(1, '{"ticket_type": 5}', '{"ticket_type": "5"}'), (2, '{"ticket_type": 5}', '{"ticket_type": 5}'),
            (3, '{"a": 1}', '{"ticket_type": "unknown"}')]
    e = RS.outcomes(spark.createDataFrame(rows, "sample_id long, true_json string, response string"))
    assert {r.sample_id: r.type_correct for r in e.collect()} == {1: False, 2: True, 3: True}


def test_distribution_keeps_many_values_out_of_one_task(spark):
    """200,000 departments: the total is one row; no exchange gathers the values."""
    df = spark.range(200_000).select(F.concat(F.lit("d"), "id").alias("d"))
    top = PR.distribution(df, "d", top=10)
    assert [r.value for r in top.collect()] == sorted(f"d{i}" for i in range(200_000))[:10]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "TakeOrderedAndProject" in plan


def test_histogram_matches_numpy(spark):
    texts = pq.read_table(f"{SF01}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    df = spark.createDataFrame([(t["doc_id"], t["text"]) for t in texts], "row_index long, original_input string")
    got = [r.n for r in PR.length_histogram(df).orderBy("bin").collect()]
    exp, _ = np.histogram([len(t["text"]) for t in texts], bins=50)
    assert got == list(exp)


def test_histogram_all_equal_and_max_in_last_bin(spark):
    df = spark.createDataFrame([(i, "abc") for i in range(5)], "row_index long, original_input string")
    got = [r.n for r in PR.length_histogram(df).orderBy("bin").collect()]
    exp, _ = np.histogram([3] * 5, bins=50)
    assert got == list(exp)
    df2 = spark.createDataFrame([(0, "a"), (1, "a" * 51)], "row_index long, original_input string")
    h = {r.bin: r.n for r in PR.length_histogram(df2).collect()}
    assert h[0] == 1 and h[49] == 1


def test_quality_report_text_layout():
    rows = [
        dict(section="overview", ord=1, key="Total Records", n=19954, pct=None, value=None),
        dict(section="overview", ord=2, key="Unique Ticket Types", n=3, pct=None, value=None),
        dict(section="overview", ord=3, key="Unique Severities", n=4, pct=None, value=None),
        dict(section="missing", ord=1, key="Assistance Request", n=19873, pct=99.594066, value=None),
        dict(section="ticket_type", ord=1, key="complaint", n=10487, pct=52.556881, value=None),
        dict(section="department", ord=1, key="Customer Service", n=19954, pct=100.0, value=None),
        dict(section="input_length", ord=1, key="Mean", n=None, pct=None, value=63.61),
        dict(section="input_length", ord=2, key="Median", n=None, pct=None, value=63.0),
        dict(section="input_length", ord=3, key="Min", n=None, pct=None, value=24.0),
        dict(section="input_length", ord=4, key="Max", n=None, pct=None, value=172.0),
        dict(section="input_length", ord=5, key="Std Dev", n=None, pct=None, value=15.1),
        dict(section="issues", ord=2, key="duplicate_inputs", n=17431, pct=None, value=None),
    ]
    text = render_quality_report(rows)
    assert "Total Records: 19954" in text
    assert "  Assistance Request: 19873 (99.59%)" in text
    assert "  complaint: 10487 (52.56%)" in text
    assert "  Customer Service: 19954 (100.00%)" in text
    assert "  Min: 24 characters" in text
    assert "  - 17431 duplicate inputs found" in text


def test_eval_report_text(spark):
    lab = _labels(spark, [("a", "a"), ("a", "b")]).withColumn("type_correct", F.lit(None).cast("boolean"))
    lab = lab.withColumn("outcome", F.lit("compared"))
    for c in MT.MATCH_COLUMNS:
        lab = lab.withColumn(c, F.lit(None).cast("boolean"))
    text = render_eval_report(MT.eval_report(lab))
    assert "Overall Accuracy: 0.5000" in text and "Total Samples Evaluated: 2" in text


def test_metrics_fuzz_against_python(spark):
    import random
    rnd = random.Random(9)
    labels = ["a", "b", "c", "d", "error"]
    pairs = [(rnd.choice(labels[:3]), rnd.choice(labels)) for _ in range(500)]
    lab = _labels(spark, pairs)
    names = sorted({x for p in pairs for x in p})
    per = {}
    for l in names:
        tp = sum(1 for t, p in pairs if t == l and p == l)
        sup = sum(1 for t, _ in pairs if t == l)
        pr = sum(1 for _, p in pairs if p == l)
        prec = tp / pr if pr else 0.0
        rec = tp / sup if sup else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        per[l] = (prec, rec, f1, sup)
    got = {r.label: r for r in MT.class_metrics(lab).collect()}
    assert set(got) == set(names)
    for l, (p, r, f, s) in per.items():
        g = got[l]
        assert (round(p, 6), round(r, 6), round(f, 6), s) == (g.precision, g.recall, g.f1, g.support)
    avg = {r.average: r for r in MT.avg_metrics(MT.class_metrics(lab)).collect()}
    n = len(pairs)
    assert abs(avg["macro avg"].f1 - sum(v[2] for v in per.values()) / len(per)) < 1e-5
    assert abs(avg["weighted avg"].recall - sum(v[1] * v[3] for v in per.values()) / n) < 1e-5
    cm = {(r.true_label, r.pred_label): r.n for r in MT.confusion_matrix(lab).collect()}
    assert cm == Counter(pairs)


def test_approximate_profile_options(spark):
    df = spark.createDataFrame([(i, "x" * (i % 50 + 1), ["a", "b", "c"][i % 3], "low")
                                for i in range(1000)],
                               "row_index long, original_input string, ticket_type string, severity string")
    exact = PR.length_stats(df).first()
    approx = PR.length_stats(df, approximate=True).first()
    assert abs(exact.median - approx.median) <= 1 and exact["min"] == approx["min"]
    q = PR.quality_summary(df, approximate=True).first()
    assert (q.unique_ticket_types, q.unique_severities) == (3, 1)


def test_duplicate_rows_with_a_hot_value(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 50}") for i in range(3000)]
    rows.append((5000, None))
    rows.append((5001, None))
    df = spark.createDataFrame(rows, "row_index long, original_input string")
    got = {r.row_index: r.is_duplicate for r in PR.duplicate_rows(df).collect()}
    seen, exp = set(), {}
    for i, t in sorted(rows):
        exp[i] = t in seen
        seen.add(t)
    assert got == exp
    # the hot value is spread over every salt (join keys), not one
    salts = (df.where("original_input = 'hot text'")
             .select(F.pmod(F.xxhash64("row_index"), F.lit(PR.DUPLICATE_SALTS)).alias("s")).distinct().count())
    assert salts == PR.DUPLICATE_SALTS


def test_null_label_is_one_label(spark):
    lab = _labels(spark, [(None, None), (None, "a"), ("a", "a")])
    m = {r.label: r for r in MT.class_metrics(lab).collect()}
    assert set(m) == {None, "a"} and m[None].support == 2 and m[None].precision == 1.0
    cm = {(r.true_label, r.pred_label): r.n for r in MT.confusion_matrix(lab).collect()}
    assert cm == {(None, None): 1, (None, "a"): 1, ("a", "a"): 1}


GOLDEN = """Overall Accuracy: 0.5000
Total Samples Evaluated: 2

2. CLASSIFICATION REPORT
--------------------------------------------------

complaint:
  Precision: 1.0000
  Recall: 0.5000
  F1-Score: 0.6667
  Support: 2

error:
  Precision: 0.0000
  Recall: 0.0000
  F1-Score: 0.0000
  Support: 0

Macro Average:
  Precision: 0.5000
  Recall: 0.2500
  F1-Score: 0.3333

3. FIELD-LEVEL ACCURACY
--------------------------------------------------
(For correctly classified tickets)

severity: 1.0000
"""


def test_eval_report_golden_text(spark):
    rows = [(1, "my input", '{"ticket_type": "complaint", "severity": "low"}', '{"ticket_type": "complaint", "severity": "low"}'),
            (2, "other", '{"ticket_type": "complaint"}', "nothing")]
    e = RS.outcomes(spark.createDataFrame(rows, "sample_id long, user_input string, true_json string, response string"))
    text = render_eval_report(MT.eval_report(e), MT.sample_predictions(e))
    assert GOLDEN in text
    assert "Parse Error Rate: 0.5000\nDomain Error Rate: 0.0000\n" in text
    assert text.endswith("Correct Predictions:\n\nExample 1:\nInput: my input\nTrue Type: complaint\n"
                         "Predicted Type: complaint\n\nIncorrect Predictions:\n")


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_dense_grid_has_every_cell(spark, block):
    import random
    rnd = random.Random(block)
    names = [f"label {k}" for k in range(9)] + [None, "", "="]
    rows = [(rnd.choice(names[:8]), rnd.choice(names[3:])) for _ in range(60)]
    got = {}
    for r in MT.dense_grid(spark.createDataFrame(rows, "true_label string, pred_label string"), block).collect():
        assert len(r.pred_labels) == len(r.counts) and r.pred_labels == sorted(r.pred_labels, key=lambda x: (x is not None, x or ""))
        for p, n in zip(r.pred_labels, r.counts):
            assert (r.true_label, p) not in got
            got[r.true_label, p] = n
    axis = {x for row in rows for x in row}
    assert got == {(t, p): rows.count((t, p)) for t in axis for p in axis}
    assert MT.dense_grid(spark.createDataFrame([], "true_label string, pred_label string")).collect() == []
