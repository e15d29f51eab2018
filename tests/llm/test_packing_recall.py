"""Retrieval of the packing operator against BM25 over all documents and all terms."""

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from ticketloom.llm import packing

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus():
    ranks = packing.read_vocabulary(public_tokenizers.path(packing.VOCABULARY))
    enc = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = pq.read_table(f"{SF01}/documents.parquet").to_pydict()
    return ranks, rows["doc_id"], [np.array(enc.encode_ordinary(t or "") + [1], np.int64) for t in rows["text"]]


def brute_neighbours(ids, seeds, size, k1=1.2, b=0.75):
    """Plain BM25: every distinct term of the seed, every document."""
    n, mean = len(ids), sum(map(len, ids)) / len(ids)
    counts = [dict(zip(*(x.tolist() for x in np.unique(d, return_counts=True)))) for d in ids]
    df = {}
    for c in counts:
        for t in c:
            df[t] = df.get(t, 0) + 1
    idf = {t: np.log1p((n - m + 0.5) / (m + 0.5)) for t, m in df.items()}
    out = {}
    for s in seeds:
        score = [sum(idf[t] * c[t] * (k1 + 1) / (c[t] + k1 * (1 - b + b * len(d) / mean)) for t in counts[s].keys() & c.keys()) for c, d in zip(counts, ids)]
        score[s] = 0
        out[s] = score
    return out


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_recall_at_ten(spark, corpus, monkeypatch, parts):
    """The shards that Spark builds, whatever the scan's partitions, hold the neighbours that a search of everything finds."""
    ranks, doc_ids, ids = corpus
    docs = spark.read.parquet(f"{SF01}/documents.parquet").repartition(parts, "doc_id")
    text = packing.narrow_input(docs, "doc_id", "text")
    path = packing.scratch_path(spark, "recall-ids")
    shared = spark.sparkContext.broadcast((ranks, public_tokenizers.PATTERN))
    text.mapInArrow(packing._tokens(shared, 1), "doc_id bigint, ids binary, wide boolean").write.parquet(path)
    size = max(ranks.values()) + 1
    df = np.zeros(size)
    for d in ids:
        df[np.unique(d)] += 1
    idf, mean = np.log1p((len(ids) - df + 0.5) / (df + 0.5)), sum(map(len, ids)) / len(ids)
    dealt = packing.by_content(spark.read.parquet(path), idf, sum(map(len, ids)), packing.SHARD_TOKENS, len(ids), packing.SHARD_DOCS)
    shards = {}
    for r in dealt.select("doc_id", F.spark_partition_id().alias("p")).collect():
        shards.setdefault(r.p, []).append(r.doc_id)
    place = {i: k for k, i in enumerate(doc_ids)}
    seeds = np.random.default_rng(1).choice(len(ids), 200, replace=False).tolist()
    want = brute_neighbours(ids, seeds, size)
    hits = 0
    for own in shards.values():
        own = [place[i] for i in own]
        shard = packing.Shard([ids[k].astype(np.uint32) for k in own], idf, mean)
        for s in set(seeds) & set(own):
            found = [own[d] for d in shard.neighbours(own.index(s), np.ones(len(own), bool)).tolist() if own[d] != s][:10]
            least = sorted(want[s], reverse=True)[9]
            hits += sum(want[s][d] >= least - 1e-4 for d in found)          # ties may stand in any order
    assert hits / (10 * len(seeds)) >= 0.9


def test_batched_scores_are_bm25(corpus):
    _, _, ids = corpus
    few = [d.astype(np.uint32) for d in ids[:120]]
    size = int(max(d.max() for d in few)) + 1
    want = brute_neighbours(few, range(120), size)
    df = np.zeros(size)
    for d in few:
        df[np.unique(d)] += 1
    shard = packing.Shard(few, np.log1p((120 - df + 0.5) / (df + 0.5)), sum(map(len, few)) / 120)
    for s, score in enumerate(shard.scores(list(range(120)))):
        score[s] = 0
        want_s = np.array(want[s])
        shared = np.array([len(np.intersect1d(few[s], d)) > 0 for d in few])
        assert np.allclose(score, want_s, rtol=1e-4, atol=1e-3) and not score[~shared].any()


def test_many_shards_pack_every_id_once(spark, corpus):
    ranks, doc_ids, ids = corpus
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    pieces = packing.pack_documents(docs, ranks, shard_tokens=60_000, shard_docs=100).collect()
    got = {}
    for p in pieces:
        got.setdefault(p.doc_id, []).append((p.start, p.ids))
    for i, d in zip(doc_ids, ids):
        assert b"".join(x for _, x in sorted(got[i])) == d.astype("<u4").tobytes()
    lengths = {}
    for p in pieces:
        lengths[p.sequence_id] = lengths.get(p.sequence_id, 0) + p.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values()) and sum(n == 2048 for n in lengths.values()) > 0.75 * len(lengths)     # 17 shards, each with an end


def test_copies_of_a_third_of_all_rows_are_spread(spark, corpus):
    ranks, _, _ = corpus
    rows = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'one and the same text here' ELSE concat('text ', id, ' of ', id % 17) END AS text")
    path = packing.scratch_path(spark, "hot-ids")
    shared = spark.sparkContext.broadcast((ranks, public_tokenizers.PATTERN))
    rows.mapInArrow(packing._tokens(shared, 1), "doc_id bigint, ids binary, wide boolean").write.parquet(path)
    idf = np.ones(max(ranks.values()) + 1)
    dealt = packing.by_content(spark.read.parquet(path), idf, 30_000, 10 ** 6, 3000, 150)
    sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert max(sizes) < 300 and sum(sizes) == 3000
