"""Files read in ranges against Python's own readers, with record borders anywhere."""

import csv
import io
import json
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketloom.plans import catalog as C
from ticketloom.sources import files as FI
from ticketloom.sources import splitting as SP

TEXTS = ["plain", "", " lead", "a,b", 'say "hi"', "two\nlines", 'q"\n"\nq', "\n\n", "cr\r\nlf", '""', "é🎉", "}{][", "\\", "x" * 300, ","]


def tickets(rnd, n):
    return [(rnd.choice(TEXTS) + rnd.choice(["", "!", "\n"]), rnd.choice(TEXTS)) for _ in range(n)]


def as_csv(rows, end="\r\n", names=("input", "output"), quoting=csv.QUOTE_ALL):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=quoting)
    w.writerow(names)
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [7, 1000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_ranges(spark, tmp_path, size, end):
    rnd = random.Random(size)
    parts = [tickets(rnd, n) for n in (40, 0, 1, 25)]
    for k, rows in enumerate(parts):
        (tmp_path / f"part-{k}.csv").write_bytes(as_csv(rows, end, quoting=csv.QUOTE_ALL if k % 2 == 0 else csv.QUOTE_MINIMAL).encode())
    want = []
    for k in range(len(parts)):
        df = pd.read_csv(tmp_path / f"part-{k}.csv", dtype=str)
        want += [tuple(None if pd.isna(x) else x for x in r) for r in df.itertuples(index=False)]
    got = FI.read_tickets_csv(spark, str(tmp_path), split=True, range_size=size).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(len(want)))
    assert [(r.input, r.output) for r in got] == want


def test_csv_ranges_cut_one_file(spark, tmp_path):
    path = tmp_path / "one.csv"
    rows = [(f"{k}\n\"{k}\"", "o" * (k % 50)) for k in range(3000)]
    path.write_text(as_csv(rows))
    with SP.range_bytes(spark, 4096):
        lines = SP.pieces(spark, str(path))
    assert lines.select("block").distinct().count() > 10
    got = FI.read_tickets_csv(spark, str(path), range_size=4096).orderBy("row_index").collect()      # larger than a range: split
    assert [(r.input, r.output or "") for r in got] == rows


def test_csv_blank_lines_bom_and_own_index(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿row_index,input,output\n\n7,"a\n\nb",x\n   \n9,c,\n\n'.encode())
    got = FI.read_tickets_csv(spark, str(tmp_path), split=True, range_size=5).orderBy("row_index").collect()
    assert [tuple(r) for r in got] == [(7, "a\n\nb", "x"), (9, "c", None)]
    (tmp_path / "b.csv").write_text("input,output\n")
    with pytest.raises(ValueError, match="differ"):
        FI.read_tickets_csv(spark, str(tmp_path), split=True)
    with pytest.raises(ValueError, match="no column output"):
        (tmp_path / "c").mkdir()
        (tmp_path / "c" / "c.csv").write_text("input\nx\n")
        FI.read_tickets_csv(spark, str(tmp_path / "c"), split=True)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "d.csv").write_text("input,output\n")
    assert FI.read_tickets_csv(spark, str(tmp_path / "d"), split=True).collect() == []


def values(rnd, n):
    def one(depth):
        kind = rnd.randrange(9 if depth < 3 else 6)
        if kind >= 7:
            return {rnd.choice("abcd") + str(k): one(depth + 1) for k in range(rnd.randrange(3))}
        if kind == 6:
            return [one(depth + 1) for _ in range(rnd.randrange(3))]
        return [rnd.choice(TEXTS), rnd.randrange(-99, 99), True, None, rnd.choice(["\\", '\\"', "}\"", "{", "\t\n"]), 1.5][kind]
    return [{"user_input": rnd.choice(TEXTS), "ticket_data": one(0)} if rnd.random() < 0.7 else one(0) for _ in range(n)]


@pytest.mark.parametrize("size", [5, 500])
@pytest.mark.parametrize("indent,ascii_", [(2, True), (None, False)])
def test_json_array_ranges(spark, tmp_path, size, indent, ascii_):
    rnd = random.Random(size)
    want = []
    for k, n in enumerate((30, 0, 1, 12)):
        data = values(rnd, n)
        (tmp_path / f"part-{k}.json").write_text(json.dumps(data, indent=indent, ensure_ascii=ascii_) + "\n" * (k % 2))
        want += data
    with SP.range_bytes(spark, size):
        rows = SP.json_array_elements(spark, str(tmp_path)).select("element", F.to_json("value").alias("v")).orderBy("element").collect()
    assert [r.element for r in rows] == list(range(len(want)))
    assert [json.loads(r.v) for r in rows] == want


def test_one_line_array_is_cut(spark, tmp_path):
    path = tmp_path / "one.json"
    data = [{"user_input": f"{k} }} {{ \" \\", "ticket_data": {"error": "e" * (k % 9)}} for k in range(2000)]
    path.write_text(json.dumps(data))
    with SP.range_bytes(spark, 2048):
        assert SP.pieces(spark, str(path), "}").select("block").distinct().count() > 10
    got = FI.read_sample_array(spark, str(path), range_size=2048).orderBy("sample_id").collect()
    assert [(r.sample_id, r.user_input, r.error, r._ok) for r in got] == [(k, d["user_input"], d["ticket_data"]["error"], True) for k, d in enumerate(data)]


@pytest.mark.parametrize("text", ['{"a": 1}', '[{"a": 1}', '[{"a": 1}, ]', '[{"a": 1} {"b": 2}]', '[{"a": 1}]]', '["x]', '[{"a" 1}]', "[,]", "null", '[{"a": "}]'])
def test_no_arrays(spark, tmp_path, text):
    with pytest.raises(json.JSONDecodeError if text not in ('{"a": 1}', "null") else AssertionError):
        assert isinstance(json.loads(text), list)
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="no JSON array|MALFORMED|is no JSON array"):
        SP.json_array_elements(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("size", [3, 50])
def test_numbered_lines(spark, tmp_path, size):
    rnd = random.Random(size)
    want = []
    for k, n in enumerate((20, 0, 7)):
        lines = [rnd.choice(["", "a", "é" * 9, "x y\r", "}"]) for _ in range(n)]
        (tmp_path / f"part-{k}.txt").write_bytes(("\n".join(lines) + ("\n" if n else "")).encode())
        want += lines
    with SP.range_bytes(spark, size):
        got = SP.numbered_lines(spark, str(tmp_path)).orderBy("line").collect()
    assert [(r.line, r.value) for r in got] == list(enumerate(want))


# -- arrays written -------------------------------------------------------------

def test_array_files_are_pythons_bytes(spark, tmp_path):
    rnd = random.Random(9)
    data = [{"id": k, "t": rnd.choice(TEXTS), "v": [rnd.choice(TEXTS), {}, None]} for k in range(1003)]
    from ticketloom.functions import jsonx
    df = spark.createDataFrame([(d["id"], json.dumps(d)) for d in data], "k long, t string").repartition(7)
    path = FI.write_json_array(df.select("k", jsonx.py_dumps("t", level=1).alias("element")), str(tmp_path / "out"), ["k"], per_file=100)
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    assert len(parts) == 11
    for k, p in enumerate(parts):
        assert p.read_text() == json.dumps(data[100 * k:100 * k + 100], indent=2) + "\n"
    back = FI.read_sample_array(spark, path, split=True, range_size=512)
    assert back.count() == 1003 and back.where("_ok").count() == 0        # elements, but no samples


def test_array_of_nothing_and_of_failed_tasks(spark, tmp_path):
    empty = spark.createDataFrame([], "k long, element string")
    (part,) = [p for p in (tmp_path / "x").iterdir() if p.name.startswith("part-")] if FI.write_json_array(empty, str(tmp_path / "x"), ["k"]) else []
    assert json.loads(part.read_text()) == []
    bad = spark.range(50).select(F.col("id").alias("k"), F.when(F.col("id") == 40, F.raise_error(F.lit("stop")).cast("string")).otherwise("1").alias("element"))
    with pytest.raises(Exception, match="stop"):
        FI.write_json_array(bad, str(tmp_path / "y"), ["k"], per_file=5)
    assert not (tmp_path / "y").exists() or not [p for p in (tmp_path / "y").iterdir() if p.name.startswith("part-")]


def test_pairs_by_position(spark, tmp_path):
    truth, replies = [f"t{k}" for k in range(30)], [f"r{k}" for k in range(25)]
    for name, cuts in (("truth", [0, 3, 30]), ("replies", [0, 10, 11, 25])):
        (tmp_path / name).mkdir()
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            (tmp_path / name / f"part-{k}").write_text("".join(x + "\n" for x in (truth if name == "truth" else replies)[a:b]))
    from ticketloom.operators.responses import pair_by_position
    with SP.range_bytes(spark, 8):
        t, r = SP.numbered_lines(spark, str(tmp_path / "truth")), SP.numbered_lines(spark, str(tmp_path / "replies"))
    got = {x.sample_id: (x.truth_line, x.prediction_line) for x in pair_by_position(t, r).collect()}
    assert got == {k: (t, replies[k] if k < 25 else None) for k, t in enumerate(truth)}
    swapped = {x.sample_id: x.prediction_line for x in pair_by_position(r, t).collect()}
    assert swapped == dict(enumerate(truth[:25]))


def test_running_counts_carry_over_batches():
    """Quotes and starts of records of each range, however its lines are cut into batches."""
    rnd = random.Random(5)
    lines, want = [], []
    for file, block in (("a", 0), ("a", 90), ("b", 90), ("c", 0)):
        quotes, starts = 0, [0, 0]
        for _ in range(rnd.randrange(1, 30)):
            value = rnd.choice(["", " ", "x", '"x', 'x"', '"x"', '"'])
            odd, blank = value.count('"') % 2, not value.strip()
            for k in (0, 1):
                starts[k] += quotes % 2 == k and not blank
            want.append((quotes % 2, *starts))
            quotes += odd
            lines.append((file, block, len(lines), value, odd, blank))
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("id", pa.int64()), ("value", pa.string()), ("odd", pa.int32()), ("blank", pa.bool_())])
    for size in (1, 4, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*lines[k:k + size]), schema)], schema=schema)
                   for k in range(0, len(lines), size)]
        batches.insert(1, batches[0].slice(0, 0))
        got = pa.Table.from_batches(list(SP._running(iter(batches)))).to_pylist()
        assert [(r["inside"], r["starts0"], r["starts1"]) for r in got] == want
        assert [r["value"] for r in got] == [x[3] for x in lines]


@pytest.mark.parametrize("name,folder", [("scan_split_tickets", "large_csv"), ("scan_split_array", "large_array")])
def test_large_inputs_are_several_files(spark, tmp_path, monkeypatch, name, folder):
    """No task writes all rows: the files follow the bytes, and the numbers and rows are those of one file."""
    docs = [(k, f"help with {k}\n\"loan\" " + "x" * (k % 50)) for k in range(1, 401)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    results = []
    for size in (1 << 30, 8000):
        monkeypatch.setattr(FI, "FILE_BYTES", size)
        monkeypatch.setattr(C, "scratch_path", lambda _, part: str(tmp_path / f"{size}-{part}"))
        results.append(sorted(map(str, C.CATALOG[name](spark, str(tmp_path)).collect())))
    assert results[0] == results[1] and len(results[0]) > 300
    files = [len(list((tmp_path / f"{size}-{folder}").glob("part-*"))) for size in (1 << 30, 8000)]
    assert files[0] == 1 and files[1] > 5
