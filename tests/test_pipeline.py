"""End to end: entry, a fast oracle subset at sf0.001, fixtures against
FIXTURES.md, literal rows through reply parsing, file round trips."""

import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001, SF01
from oracle_check import compare
from ticketloom.operators import responses as RS
from ticketloom.operators import clean as CL
from ticketloom.operators import records as RC
from ticketloom.plans import catalog as C
from ticketloom.plans.oracle_sql import ORACLE
from ticketloom.session import scratch_path
from ticketloom.sources import files as FI
from ticketloom.sources import literals as LT


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["section", "ord", "ord2", "key", "n", "pct", "value"]


def test_every_query_has_oracle_or_is_rows_only():
    assert set(C.CATALOG) == {k for k in ORACLE if k in C.CATALOG}


FAST = ["parse_counts", "clean_tickets", "quality_report", "class_keywords", "balance_classes",
        "split_three_way", "outcome_labels", "class_metrics", "confusion_matrix", "missing_values",
        "length_histogram", "validate_samples", "training_prompts", "eval_report"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_subset_sf0001(spark, name):
    assert compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF001, verbose=False)


def test_fixture_counts_match_fixtures_md(spark):
    r = C.q_parse_counts(spark, SF01).first()
    assert (r.parsed, r.parse_errors) == (966, 34)
    d = {r.value: r.n for r in C.q_type_distribution(spark, SF01).collect()}
    assert d == {"complaint": 483, "inquiry": 295, "assistance": 188}


def test_outcome_table_matches_fixtures_md(spark):
    got = {(r.true_label, r.pred_label): r.n for r in C.q_confusion_matrix(spark, SF01).collect() if r.n}
    exp = {("assistance", "assistance"): 151, ("assistance", "complaint"): 30, ("assistance", "error"): 91,
           ("assistance", "inquiry"): 31, ("assistance", "unknown"): 30,
           ("complaint", "complaint"): 138, ("complaint", "error"): 67, ("complaint", "inquiry"): 22,
           ("complaint", "unknown"): 23,
           ("inquiry", "complaint"): 31, ("inquiry", "error"): 91, ("inquiry", "inquiry"): 181,
           ("inquiry", "unknown"): 30,
           ("out_of_domain", "domain_error"): 24, ("out_of_domain", "out_of_domain"): 60}
    assert got == exp


def test_literal_rows_through_outcomes(spark):
    ch = LT.challenge_samples(spark)
    assert ch.count() == 8 and ch.where("error IS NOT NULL").count() == 1
    # truth = the challenge tickets, reply = a refusal for every row
    truth = F.when(F.col("error").isNotNull(), F.lit('{"error": "x"}')).otherwise(
        F.concat(F.lit('{"ticket_type": "'), F.col("ticket_type"), F.lit('"}')))
    df = ch.select(F.col("sample_id"), truth.alias("true_json"),
                   F.lit('[INST] q [/INST] {"error": "Request outside banking domain"}').alias("response"))
    out = {r.sample_id: (r.true_label, r.pred_label) for r in RS.outcomes(df).collect()}
    assert out[-26] == ("out_of_domain", "out_of_domain")
    assert out[-21] == ("complaint", "error")
    assert sum(1 for v in out.values() if v[1] == "error") == 7


def test_sample_array_file_roundtrip(spark, tmp_path):
    data = [{"user_input": "hi", "ticket_data": {"error": "Request outside banking domain"}},
            {"user_input": "lost card", "ticket_data": {k: "x" for k in
             ["ticket_type", "title", "description", "severity", "department_impacted",
              "service_impacted", "preferred_communication"]}},
            {"user_input": "bad", "ticket_data": {"ticket_type": "complaint"}},
            {"ticket_data": {"error": "e"}}]
    p = os.path.join(tmp_path, "samples.json")
    with open(p, "w") as f:
        json.dump(data, f, indent=2)
    got = FI.read_sample_array(spark, p)
    assert got.where("_ok").count() == 2 and got.count() == 4


def test_sample_array_keeps_null_inputs_and_skips_texts(spark, tmp_path):
    p = os.path.join(tmp_path, "odd.json")
    with open(p, "w") as f:
        json.dump([{"user_input": None, "ticket_data": {"error": "e"}}, {"user_input": "x", "ticket_data": "plain text"},
                   {"user_input": "y", "ticket_data": [1]}], f)
    got = FI.read_sample_array(spark, p)
    assert [(r.user_input, r.error) for r in got.where("_ok").collect()] == [(None, "e")] and got.count() == 3


def test_keyless_csv(spark, tmp_path):
    for k, rows in enumerate((["a", "b"], ["c"], ["d", "e"])):
        with open(os.path.join(tmp_path, f"part-{k}.csv"), "w") as f:
            f.write("input,output\n" + "".join(f'"{r} ""q""\nline","{{}}"\n' for r in rows))
    back = sorted((r.row_index, r.input) for r in FI.read_tickets_csv(spark, str(tmp_path)).collect())
    assert back == [(i, f'{c} "q"\nline') for i, c in enumerate("abcde")]
    with open(os.path.join(tmp_path, "part-9.csv"), "w") as f:
        f.write("text,output\n1,2\n")
    with pytest.raises(ValueError, match="input"):
        FI.read_tickets_csv(spark, os.path.join(tmp_path, "part-9.csv"))


def test_written_values_keep_their_json_type(spark):
    raw = spark.createDataFrame([(1, "t", '{"Ticket Type": "inquiry", "Title": 7, "Description": {"a": 1}, "Service Impacted": [true]}')],
                                "row_index long, input string, output string")
    recs = RC.training_records(CL.clean_tickets(CL.parse_tickets(raw)))
    line = spark.read.text(FI.write_samples_jsonl(recs, scratch_path(spark, "typed_test"))).first().value
    t = json.loads(line)["ticket_data"]
    assert (t["title"], t["description"], t["service_impacted"]) == (7, {"a": 1}, [True])
    assert t["department_impacted"] == "Customer Service"          # no row has the key


def test_off_local_masters_need_a_shared_folder():
    from types import SimpleNamespace as N
    from ticketloom.session import ensure_checkpoint_dir
    conf = N(get=lambda k, d=None: d)
    sc = N(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(N(sparkContext=sc, conf=conf))


def test_csv_roundtrip_keeps_texts(spark):
    raw = spark.createDataFrame([(1, 'a "q", b\nline2', '{"a": 1}'), (2, "NA", None), (3, " pad ", "")],
                                "row_index long, input string, output string")
    path = FI.write_tickets_csv(raw, scratch_path(spark, "csv_test"))
    back = {r.row_index: (r.input, r.output) for r in FI.read_tickets_csv(spark, path).collect()}
    assert back == {1: ('a "q", b\nline2', '{"a": 1}'), 2: (None, None), 3: (" pad ", None)}


PLAN_QUERIES = ["clean_tickets", "quality_summary", "class_keywords", "balance_classes", "split_three_way",
                "outcome_labels", "class_metrics", "duplicate_rows", "word_counts", "validate_samples",
                "training_prompts", "split_leakage"]


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_plans_stay_in_the_jvm(spark, name):
    """No Python UDF, cartesian product or nested-loop join in table work."""
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_keyword_top_k_is_limited_before_the_shuffle(spark):
    plan = E.queries()["class_keywords"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_written_samples_are_python_json_with_exact_keys(spark):
    recs = C.records(spark, SF001)
    path = FI.write_samples_jsonl(recs, scratch_path(spark, "k1_test"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == recs.count() > 0
    fields = ["ticket_type", "title", "description", "severity", "department_impacted",
              "service_impacted", "preferred_communication"]
    for line in lines:
        obj = json.loads(line)
        assert list(obj) == ["user_input", "ticket_data"]
        t = obj["ticket_data"]
        assert list(t)[:7] == fields
        assert ("assistance_request" in t) == (t["ticket_type"] == "assistance")


def test_split_writer_partitions(spark):
    df = C.q_write_splits(spark, SF001)
    got = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert got["challenge"] == 8
    assert set(got) == {"train", "validation", "test", "challenge"}
    assert df.where("split = 'test' AND error IS NOT NULL").count() == 5


def test_scratch_tables_live_under_the_checkpoint_dir(spark):
    from ticketloom.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    assert base and scratch_path(spark, "x").startswith(base.rstrip("/") + "/")
