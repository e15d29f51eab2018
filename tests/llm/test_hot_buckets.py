"""Buckets and hubs that hold most of the rows, against plain Python."""

import random

from pyspark.sql import functions as F

from ticketloom.llm import simhash
from ticketloom.llm.components import components


def _roots(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in nodes}


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_hot_variants_lose_no_link(spark):
    r = random.Random(2)
    half = r.getrandbits(32)
    prints = {half | (r.getrandbits(32) << 32) for _ in range(700)}                    # one half is everybody's
    prints |= {p ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for p in list(prints)[:300]}
    prints |= {r.getrandbits(64) for _ in range(100)}
    prints = sorted(map(_signed, prints))
    near = [(a, b) for k, a in enumerate(prints) for b in prints[:k] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert len(near) >= 250
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = _roots(prints, near)
    for hot in (50, 10**6):
        links = [tuple(x) for x in simhash.simhash_links(df, hot=hot).collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in links)
        assert _roots(prints, links) == want


def test_variants_are_made_in_the_set_number_of_partitions(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = simhash.simhash_links(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(xxhash64(fp" in plan           # Spark drops a second shuffle on fp itself


def test_hubs_are_spread_and_components_right(spark):
    r = random.Random(3)
    edges = [(0, k) for k in range(1, 3000)] + [(5000 + k, 5001 + k) for k in range(12)] + [(9, 9), (7000, 6999), (None, 3)]
    edges += [(r.randrange(8000, 8500), r.randrange(8000, 8500)) for _ in range(300)]
    real = [(a, b) for a, b in edges if a is not None and a != b]
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in real for x in e}
    assert got == _roots(nodes, real)
