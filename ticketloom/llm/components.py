"""Connected components by alternating large-star and small-star steps.

A node may have any number of edges: its smallest neighbour is sent to ``PARTS`` keys a node, over which
its edges are spread by their other end, so that a hub's edges never meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import attach, materialize

PARTS = 64


def _with_low(edges: DataFrame, low: DataFrame) -> DataFrame:
    """The edges with their node's row of ``low``."""
    return attach(edges.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(PARTS))), low, "a", "part")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _with_low(both, low).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = _with_low(edges, low).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every node of the bigint edges ``(a, b)``, in any direction.

    ``component`` is the smallest id reachable.  Loops, nulls and repeated edges are allowed;
    a node without an edge to another node has no row.  Each round is a few joins and
    aggregates whose result goes to the shared checkpoint folder; it ends when a round leaves
    the edges as they were, by their count and the sum of their hashes."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                   F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = materialize(_small_star(_large_star(now)))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (now.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct())
