"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``2k + 1`` bits have a 32-bit half in which they differ in at most
``k`` bits, and two fingerprints within ``2k`` bits too.  So every distinct fingerprint emits,
for each half, all variants of that half within ``k = radius // 2`` bits (half the radius,
rounded down); linked fingerprints collide on at least one variant.  The variants are
shuffled, and a bucket's members are verified by the bit distance of the whole fingerprint.
A bucket of more than ``HOT`` members is cut into blocks by a hash of the fingerprint, and every
pair of blocks is a group of its own.  A group only reports the links that join its members (a
forest), never all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import attach, documents, materialize, narrow_input, partition_id, prepare
from ticketloom.llm.components import components

SHINGLE, BITS, SEED = 3, 3, 42
HOT = 8192             # members of a variant beyond which its block pairs are spread over tasks
BLOCK = 1024           # members compared at a time; a matter of memory, all blocks are compared


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash: a bit is set if over half of the shingles' hashes set it."""
    words = text.encode().lower().split()       # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    line = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], stops[:-1]])[:n].tolist()
    ends = (stops[min(size, len(words)) - 1:] - 1).tolist()
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n)
    for k in range(0, n, 1 << 16):
        part = hashes[k:k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(size):
    def run(batches):
        part = partition_id()
        for batch in batches:
            prints = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64)
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, keep), pa.array(prints.view(np.int64)), pa.array(np.full(len(prints), part, np.int64))],
                [*keep, "fp", "run"])
    return run


def ball(radius: int, width: int = 32) -> np.ndarray:
    """Every mask of ``width`` bits with at most ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1)
                     for c in itertools.combinations(range(width), r)], np.uint64)


def _variants(radius):
    masks = ball(radius)

    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(fps), 4096):
                fp = fps[k:k + 4096]
                for half in (0, 1):
                    own = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
                    keys = (own[:, None] ^ masks[None, :]) | np.uint64(half << 32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fp, len(masks)).view(np.int64))],
                        ["variant", "fp"])
    return run


def _forest(fps: np.ndarray, bits: int) -> tuple[list, list]:
    """Links within ``bits`` that join the members of one bucket (each link new to its forest)."""
    parent = np.arange(len(fps))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right = [], []
    for i in range(0, len(fps), BLOCK):
        for j in range(i, len(fps), BLOCK):
            near = np.bitwise_count(fps[i:i + BLOCK, None] ^ fps[None, j:j + BLOCK]) <= bits
            a, b = np.nonzero(np.triu(near, 1) if i == j else near)
            for x, y in zip((a + i).tolist(), (b + j).tolist()):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    left.append(x)
                    right.append(y)
    return left, right


def _links(bits):
    def bucket(fps):
        fps = np.unique(fps)
        a, b = _forest(fps, bits)
        return fps[a].view(np.int64), fps[b].view(np.int64)

    def run(batches):
        rest_key, rest = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                keys, fps, done = rest_key, rest, len(rest)
            else:
                keys = np.concatenate([rest_key, batch.column("variant").to_numpy()])
                fps = np.concatenate([rest, batch.column("fp").to_numpy().view(np.uint64)])
                if not len(keys):
                    continue
                done = int(np.searchsorted(keys, keys[-1]))     # the last bucket may go on
                rest_key, rest = keys[done:], fps[done:]
            keys, fps = keys[:done], fps[:done]
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, int)
            size = np.diff(cuts)
            found = [bucket(fps[s:s + n]) for s, n in zip(cuts[:-1][size > 1].tolist(), size[size > 1].tolist())]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])
    return run


def simhash_links(prints: DataFrame, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """Links ``(a, b)`` that join all distinct fingerprints ``fp`` (bigint) within ``bits``.

    Groups hold about ``2 * hot`` members at most, however many share a variant."""
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a set number of partitions, by a key of its own, as Spark leaves out a shuffle on the key that rows already
    # lie by: what is small here is 66 times as large after the next step
    spread = prints.select("fp").distinct().repartition(n, F.xxhash64("fp"))
    variants = spread.mapInArrow(_variants(bits // 2), "variant bigint, fp bigint")
    full = materialize(variants.groupBy("variant").agg(F.count("*").alias("size")).where(F.col("size") > hot))
    groups = variants
    if not full.isEmpty():
        blocks = F.ceil(F.col("size") / hot).cast("bigint")
        own = F.pmod(F.xxhash64("fp", F.lit(1)), blocks)
        pair = lambda other: F.xxhash64("variant", F.least(own, other), F.greatest(own, other))
        cut = variants.join(full, "variant").select(
            F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), blocks - 1), pair)).alias("variant"), "fp")
        groups = variants.join(full, "variant", "left_anti").unionByName(cut)
    buckets = groups.repartition("variant").sortWithinPartitions("variant")
    return buckets.mapInArrow(_links(bits), "a bigint, b bigint").distinct()


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  size: int = SHINGLE, bits: int = BITS, row_col: str | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each input row.

    Fingerprints of at most ``bits`` differing bits link; ``component_id`` is the smallest id
    reachable.  Texts without words (null too) have fingerprint zero and link like others;
    repeated rows share a fingerprint; null ids never are a component's smallest unless it
    holds no other.  ``row_col`` names a unique bigint column; with it ``row`` and ``kept`` are
    returned too: exactly one row of a component is kept, the one of the smallest id (nulls last)
    and of these the smallest row."""
    prepare(docs.sparkSession)
    rows = materialize(narrow_input(docs, id_col, text_col, row_col)
                       .mapInArrow(_fingerprints(size), ("row bigint, " if row_col else "") + "doc_id bigint, fp bigint, run bigint"))
    least = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row") if row_col else F.col("doc_id")
    smallest = rows.groupBy("run", "fp").agg(F.min(least).alias("low"))
    found = components(simhash_links(rows, bits))
    of = (smallest.groupBy("fp").agg(F.min("low").alias("low"))
          .join(found.withColumnRenamed("id", "fp"), "fp", "left")
          .withColumn("component", F.coalesce("component", "fp")))
    lows = of.groupBy("component").agg(F.min("low").alias("component_id"))
    of = of.withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(64)))
    table = attach(of, lows, "component", "part").select("fp", "component_id")
    out, fingerprint = attach(rows, table, "fp", "run"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    if not row_col:
        return out.select("doc_id", fingerprint, "component_id")
    return out.select("row", "doc_id", fingerprint, F.col("component_id.doc_id").alias("component_id"),
                      (F.col("component_id.row") == F.col("row")).alias("kept"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(documents(spark, sf_dir))
