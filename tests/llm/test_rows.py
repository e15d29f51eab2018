"""Rows keep their numbers however a scan is cut, and whatever their columns are called."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ticketloom.llm import exact_dedup
from ticketloom.llm.common import numbered_rows

SF01 = "/root/testdata/sf0.01"
CUTS = [("1m", "1"), ("2k", "8"), ("1m", "40")]


def cut(spark, size, least):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.minPartitionNum", least)


@pytest.fixture
def cuts(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda k: cut(spark, *CUTS[k])
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.minPartitionNum")


def docs(spark, tmp_path, parts=4):
    rows = [(k % 5 if k % 4 else None, f"text {k // 2} of some words", 7 + k, k) for k in range(40)]
    path = str(tmp_path / "docs")
    (spark.createDataFrame(rows, "doc_id long, text string, __row long, row long").repartition(parts, "row").write.option("parquet.block.size", 256).parquet(path))
    return spark.read.parquet(path)


def test_numbers_do_not_move(spark, tmp_path, cuts):
    df = docs(spark, tmp_path)
    seen = []
    for k in range(3):
        cuts(k)
        rows, name = numbered_rows(df)
        assert name == "__row_" and rows.columns == [*df.columns, name]
        seen.append(sorted((r[name], r.row, r["__row"]) for r in rows.collect()))
    assert seen[0] == seen[1] == seen[2] and len({n for n, _, _ in seen[0]}) == 40


def test_rows_of_no_files(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, `odd name` string")
    rows, name = numbered_rows(df.unionByName(df))
    got = rows.collect()
    assert len({r[name] for r in got}) == 6 and rows.columns == ["doc_id", "odd name", name]
    assert rows.select(name).collect() is not None and numbered_rows(df.limit(0))[0].collect() == []


def test_a_cut_between_decision_and_use(spark, tmp_path, cuts, monkeypatch):
    """The scan is cut otherwise after the duplicates were found and before rows are dropped."""
    df = docs(spark, tmp_path)
    whole = exact_dedup.exact_dedup

    def then_recut(*args, **kwargs):
        cuts(0)
        out = whole(*args, **kwargs).checkpoint(eager=True)
        cuts(1)
        return out
    cuts(0)
    want = sorted(map(str, corpus_pipeline.exact_duplicates(spark, df, SF01).collect()))
    assert len(want) == 20
    monkeypatch.setattr(exact_dedup, "exact_dedup", then_recut)
    assert sorted(map(str, corpus_pipeline.exact_duplicates(spark, df, SF01).collect())) == want


def test_stages_keep_columns_whatever_their_names(spark, tmp_path):
    base = spark.read.parquet(f"{SF01}/documents.parquet").limit(60).withColumn("__row", F.lit(77)).withColumn("__file", F.lit("f")).withColumn("row", F.lit(3))
    base.write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF01)
        assert out.columns == df.columns, name
        kept = out.select("__row", "__file", "row").distinct().collect()
        assert [tuple(r) for r in kept] == [(77, "f", 3)], name
    few = df.select("doc_id", "text")
    assert corpus_pipeline.pii_surrogates(spark, few, SF01).columns == ["doc_id", "text"]
