"""Sorted digest runs merged in binomial rounds, against plain Python."""

import hashlib
import random

import pyarrow as pa

from ticketloom.llm import exact_dedup as ED

RUN = "run long, digest binary, check long, n_bytes long, n long, best struct<n_chars:long,id:long,row:long>"


def _plain(rows):
    best = {}
    for _, digest, check, n_bytes, n, (n_chars, doc, row) in rows:
        key = (bytes(digest), check, n_bytes)
        rank = (n_chars, doc is not None, doc or 0, row)
        count, old = best.get(key, (0, None))
        best[key] = (count + n, max(rank, old) if old else rank)
    return {k: (n, r[-1]) for k, (n, r) in best.items()}


def _rows(r, runs, size):
    out = []
    for row in range(size):
        text = b"hot" if r.random() < 0.3 else b"%d" % r.randrange(size // 2)
        # one in ten agrees in the digest alone, as if two texts had collided in it
        check = r.choice((1, 2)) if r.random() < 0.1 else 1
        out.append((r.randrange(runs), hashlib.sha256(text).digest(), check, len(text), 1, (r.randrange(3), r.choice((None, r.randrange(40))), row)))
    return out


def test_tree_merge_equals_plain_python(spark):
    r = random.Random(4)
    for runs, size in ((1, 5), (2, 200), (5, 400), (9, 600)):
        rows = _rows(r, runs, size)
        merged = ED.tree_merge(spark.createDataFrame(rows, RUN).repartition(runs, "run"), runs).collect()
        got = {(bytes(x.digest), x.check, x.n_bytes): (x.n, x.best.row) for x in merged}
        assert len(got) == len(merged) and got == _plain(rows)
        width = 1 << max(1, (runs - 1).bit_length())
        assert all(x.run == int.from_bytes(x.digest[:6], "big") % width for x in merged)   # each digest in its range


def test_many_runs_become_few(spark):
    rows = _rows(random.Random(7), 23, 500)
    merged = ED.tree_merge(spark.createDataFrame(rows, RUN).repartition(5, "run"), 23, max_runs=4).collect()
    assert {(bytes(x.digest), x.check, x.n_bytes): (x.n, x.best.row) for x in merged} == _plain(rows) and {x.run for x in merged} == {0, 1, 2, 3}


def test_tree_merge_of_nothing(spark):
    assert ED.tree_merge(spark.createDataFrame([], RUN), 1).isEmpty()


def test_merge_carries_over_batches():
    kind = pa.struct([("n_chars", pa.int64()), ("id", pa.int64()), ("row", pa.int64())])
    schema = pa.schema([("run", pa.int64()), ("digest", pa.binary()), ("check", pa.int64()), ("n_bytes", pa.int64()),
                        ("n", pa.int64()), ("best", kind)])
    r = random.Random(9)
    rows = sorted(((*x[:5], dict(zip(("n_chars", "id", "row"), x[5]))) for x in _rows(r, 2, 300)), key=lambda x: (*x[:4], x[5]["row"]))
    whole = None
    for size in (1, 7, 300):
        parts = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k:k + size]), schema)], schema=schema)
                 for k in range(0, len(rows), size)]
        parts.insert(1, pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema))
        got = pa.Table.from_batches(list(ED._merge(iter(parts))), schema=schema).to_pylist()
        whole = whole or got
        assert got == whole
    assert sum(x["n"] for x in whole) == 300 and len({(x["run"], x["digest"], x["check"]) for x in whole}) == len(whole)


def test_rounds_sort_and_merge_without_aggregates(spark):
    runs = spark.createDataFrame(_rows(random.Random(1), 4, 50), RUN)
    plan = ED.tree_merge(runs, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("MapInArrow") == 3 and plan.count("Exchange") == 2


def test_a_partition_of_several_batches(spark):
    """Spark's own batches say that a count is never null, and so must the row that is carried over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10")
    try:
        docs = spark.createDataFrame([(k, f"text {k % 70}" + " " * (k % 3)) for k in range(200)], "doc_id long, text string").repartition(2)
        got = ED.exact_dedup(docs).collect()
    finally:
        spark.conf.set(key, before)
    best = {k: min(range(k, 200, 70), key=lambda i: (-(i % 3), i)) for k in range(70)}
    assert len(got) == 200
    assert all((x.keep_id, x.group_size, x.kept) == (best[x.doc_id % 70], len(range(x.doc_id % 70, 200, 70)), x.doc_id == best[x.doc_id % 70]) for x in got)
