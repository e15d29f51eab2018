"""Hard-negative mining by angular triangle filtering.

Every row stores its angles to a few reference directions.  By the triangle inequality on the sphere
the angle of an anchor and a row lies between |a - b| and min(a + b, 2 pi - a - b) for each
reference's two angles, so its cosine lies between the largest cos(a + b) and the smallest cos(a - b).
Times the norms, widened by the rounding errors of the angles and then rounded inwards to integers,
this bounds the integer score of every pair; only pairs whose bounds overlap a window that matters
are scored exactly.  So the result is exact whatever the directions; they only decide how much is
scored.

Rows are measured and written once, in runs of ``2^RUN_BITS``.  Anchors, a stated query set, meet them
block by block: a group is a run or a few and a block of about ``ANCHOR_ROWS`` anchors, and gives
each anchor at most ``POSITIVES`` positives, or ``NEGATIVES`` negatives a positive, so that what
is merged afterwards is small."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.llm.common import documents, partition_id, prepare
from ticketloom.session import scratch_path

POSITIVES, NEGATIVES = 5, 3
REFERENCES = 16                 # directions, chosen from SAMPLE rows
SAMPLE = 2048                   # rows that reach the driver
RUN_BITS, ANCHOR_ROWS = 13, 2048   # rows of a run: 2^13
CHUNK = 1 << 21                 # pairs whose bounds a task holds at once
LOWEST, HIGHEST = 50, 95        # a negative's score, in hundredths of the positive's
ROWS = "row_key bigint, id bigint, label bigint, unit int, vector binary, norm double, angles binary"
WINDOWS = "windows array<struct<place:int,id:bigint,score:bigint>>"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, label, vector)`` of the rows that take part: label and vector not null, all components finite;
    a component x becomes floor(256 x).  Other columns are left out."""
    fine = F.forall(F.col(vector_col), lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return (df.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(fine)
            .select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                    F.transform(vector_col, lambda x: F.floor(256 * x.cast("double"))).alias("vector")))


def reference_directions(sample: list, count: int) -> np.ndarray:
    """``count`` unit vectors of a sample: its mean, then always the one whose largest cosine to those
    chosen is least.  Rows of no length count for nothing."""
    width = max([1] + [len(v) for v in sample])
    x = np.array([v + [0] * (width - len(v)) for v in sample], dtype=float).reshape(len(sample), width)
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0][:, None]
    if not len(x):
        return np.zeros((0, x.shape[1]))
    mean = x.mean(axis=0)
    chosen = [mean / np.linalg.norm(mean) if np.linalg.norm(mean) > 1e-9 else x[0]]
    near = x @ chosen[0]
    while len(chosen) < min(count, len(x)):
        k = int(near.argmin())
        chosen.append(x[k])
        near = np.maximum(near, x @ x[k])
    return np.array(chosen)


def _measured(refs: np.ndarray):
    """``mapInArrow``: ``(id, label, vector)`` rows to ``ROWS``, numbered by partition.  A vector of no length
    has angles 0; its scores are 0 by its norm."""
    schema = pa.schema([("row_key", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("unit", pa.int32()),
                        ("vector", pa.binary()), ("norm", pa.float64()), ("angles", pa.binary())])

    def run(batches: Iterator) -> Iterator:
        key = partition_id() << 40
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                x = np.array(row["vector"], dtype=np.int64)
                norm = float(np.linalg.norm(x.astype(float)))
                least = min(len(x), refs.shape[1])
                cos = refs[:, :least] @ x[:least] / norm if norm else np.ones(len(refs))
                top = max(abs(int(x.min())), abs(int(x.max()))) if len(x) else 0
                unit = 2 if top < 2 ** 15 else 4 if top < 2 ** 31 else 8
                out.append({"row_key": key, "id": row["id"], "label": row["label"], "unit": unit,
                            "vector": x.astype(f"<i{unit}").tobytes(), "norm": norm,
                            "angles": np.arccos(np.clip(cos, -1, 1)).astype("<f4").tobytes()})
                key += 1
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def margin(width: int) -> float:
    """What the cosine of a sum or difference of two stored angles may be off: their sum's error, from a
    cosine rounded over ``width`` products, arccos near its ends, and 32-bit storage."""
    return 4 * float(np.sqrt(2 * (width + 8) * 2.3e-16)) + 2e-6


def score_bounds(cos_a, sin_a, norms_a, cos_b, sin_b, norms_b, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer score of every pair of rows of a and b, from their angles."""
    low = np.full((len(norms_a), len(norms_b)), -1, dtype=np.float64)
    high = np.ones_like(low)
    for k in range(cos_a.shape[1]):
        c, s = np.outer(cos_a[:, k], cos_b[:, k]), np.outer(sin_a[:, k], sin_b[:, k])
        np.maximum(low, c - s, out=low)
        np.minimum(high, c + s, out=high)
    scale = np.outer(norms_a, norms_b)
    return np.ceil(scale * (low - slack) - 1e-3), np.floor(scale * (high + slack) + 1e-3)


def exact_scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products, exactly: in doubles while no partial sum can reach 2^53."""
    if not len(rows):
        return np.zeros(0, np.int64)
    top = lambda x: max(abs(int(x.min())), abs(int(x.max())))
    bound = top(rows) * top(anchor) * rows.shape[1]
    if bound < 2 ** 53:
        return (rows.astype(float) @ anchor.astype(float)).astype(np.int64)
    if bound < 2 ** 63:
        return rows.astype(np.int64) @ anchor.astype(np.int64)
    exact = rows.astype(object) @ anchor.astype(object)
    return exact.astype(np.int64)                      # raises where a score is no long


class Rows:
    """A group's rows as arrays; shorter vectors end in zeros."""

    def __init__(self, table: pa.Table, references: int):
        column = lambda c: table.column(c).to_pylist()
        self.ids, units, vectors = column("id"), column("unit"), column("vector")
        self.keys = np.array(column("row_key"), dtype=np.int64)
        self.labels = np.array(column("label"), dtype=np.int64)
        self.norms = np.array(column("norm"), dtype=float)
        angles = np.frombuffer(b"".join(column("angles")), "<f4").reshape(len(self.ids), references).astype(float)
        self.cos, self.sin = np.cos(angles), np.sin(angles)
        if len({(u, len(v)) for u, v in zip(units, vectors)}) == 1:
            self.vectors = np.frombuffer(b"".join(vectors), f"<i{units[0]}").reshape(len(vectors), -1)
        else:
            self.vectors = np.zeros((len(vectors), max(len(v) // u for u, v in zip(units, vectors))), np.int64)
            for k, (u, v) in enumerate(zip(units, vectors)):
                self.vectors[k, :len(v) // u] = np.frombuffer(v, f"<i{u}")
        # the order that settles equal scores: by id, nulls last, then by row
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k] or 0, self.keys[k]))
        self.order = np.empty(len(order), np.int64)
        self.order[order] = np.arange(len(order))


def _best(scores: np.ndarray, order: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, ties by ``order``."""
    if len(scores) > count:
        few = np.flatnonzero(scores >= np.partition(scores, len(scores) - count)[len(scores) - count])
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((order[few], -scores[few]))[:count]]


FOUND = pa.schema([("anchor_key", pa.int64()), ("place", pa.int32()), ("row_key", pa.int64()), ("row_id", pa.int64()),
                   ("score", pa.int64())])


def _search(references: int, found):
    """``cogroup`` function: bounds of all pairs of a group, then ``found(anchors, a, rows, low, high)`` for
    each anchor, which gives ``(place, row, score)``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in FOUND.names}
        if left.num_rows and right.num_rows:
            rows, anchors = Rows(left, references), Rows(right, references)
            anchors.windows = right.column("windows").to_pylist()
            width = max(rows.vectors.shape[1], anchors.vectors.shape[1])
            pad = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))
            rows.vectors, anchors.vectors = pad(rows.vectors), pad(anchors.vectors)
            step = max(1, CHUNK // len(rows.ids))
            for at in range(0, len(anchors.ids), step):
                part = slice(at, at + step)
                low, high = score_bounds(anchors.cos[part], anchors.sin[part], anchors.norms[part],
                                         rows.cos, rows.sin, rows.norms, margin(width))
                for k in range(len(low)):
                    for place, row, score in found(anchors, at + k, rows, low[k], high[k]):
                        out["anchor_key"].append(int(anchors.keys[at + k]))
                        out["place"].append(place)
                        out["row_key"].append(int(rows.keys[row]))
                        out["row_id"].append(rows.ids[row])
                        out["score"].append(int(score))
        return pa.table(out, schema=FOUND)
    return run


def _positives(anchors: Rows, a: int, rows: Rows, low: np.ndarray, high: np.ndarray):
    """The highest rows of the anchor's label: a pair is scored if its upper bound reaches the fifth lower one."""
    same = np.flatnonzero((rows.labels == anchors.labels[a]) & (rows.keys != anchors.keys[a]))
    if len(same) > POSITIVES:
        same = same[high[same] >= np.partition(low[same], len(same) - POSITIVES)[len(same) - POSITIVES]]
    scores = exact_scores(rows.vectors[same], anchors.vectors[a])
    return [(0, same[k], scores[k]) for k in _best(scores, rows.order[same], POSITIVES)]


def _negatives(anchors: Rows, a: int, rows: Rows, low: np.ndarray, high: np.ndarray):
    """The highest rows of other labels in each positive's window; only pairs whose bounds overlap one are scored."""
    # the window in integers: 50 p <= 100 n <= 95 p
    spans = [(w["place"], -(-LOWEST * w["score"] // 100), HIGHEST * w["score"] // 100) for w in anchors.windows[a]]
    near = np.zeros(len(low), dtype=bool)
    for _, least, most in spans:
        near |= (high >= least) & (low <= most)
    other = np.flatnonzero(near & (rows.labels != anchors.labels[a]))
    scores = exact_scores(rows.vectors[other], anchors.vectors[a])
    out = []
    for place, least, most in spans:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        out += [(place, other[inside[k]], scores[inside[k]]) for k in _best(scores[inside], rows.order[other[inside]], NEGATIVES)]
    return out


def _meet(rows: DataFrame, anchors: DataFrame, groups: int, references: int, found) -> DataFrame:
    """Every row against every anchor, in groups of about ``2^RUN_BITS`` rows and ``ANCHOR_ROWS`` anchors."""
    blocks = max(1, -(-anchors.count() // ANCHOR_ROWS))
    run = F.shiftright("row_key", RUN_BITS)
    left = rows.select("*", F.pmod(F.xxhash64(run), F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("k"))
    right = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
                           F.pmod(F.xxhash64("row_key"), F.lit(blocks)).alias("k"))
    key = [F.col("g").cast("bigint").alias("g"), F.col("k").cast("bigint").alias("k")]
    return (left.groupBy(*key).cogroup(right.groupBy(*key))
            .applyInArrow(_search(references, found), "anchor_key bigint, place int, row_key bigint, row_id bigint, score bigint"))


def _first(found: DataFrame, count: int) -> DataFrame:
    """The ``count`` highest rows of each anchor and place, with their ``rank`` from 1."""
    best = Window.partitionBy("anchor_key", "place").orderBy(F.desc("score"), F.col("row_id").asc_nulls_last(), "row_key")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)


def mine_hard_negatives(vectors: DataFrame, divisor: int = 50) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of ``(id, label, vector)``
    rows of integers.

    Anchors are the rows whose id ``divisor`` divides (a null id never is); a score is the integer inner
    product with the anchor, and higher ones come first, ties by smaller id, nulls last.  An anchor's
    positives are its first five other rows of its label (all, if fewer); each positive's negatives are
    the first three rows of other labels whose score is 50 to 95 hundredths of the positive's.  A window
    of a negative positive score is empty; of score 0 it holds only 0.

    Rows stand for themselves: rows that repeat an id all take part, each anchor among them has its own
    results, and equal rows may be each other's positives.  A shorter vector counts as ending in zeros,
    so an empty one scores 0.  Scores must fit a long.  No rows give no rows."""
    spark = vectors.sparkSession
    prepare(spark)
    sample = [r.vector for r in vectors.select("vector", F.xxhash64("id", "vector").alias("h")).orderBy("h").limit(SAMPLE).collect()]
    refs = reference_directions(sample, REFERENCES) if sample else np.zeros((0, 1))
    path = scratch_path(spark, "angles")
    vectors.mapInArrow(_measured(refs), ROWS).write.parquet(path)
    rows = spark.read.schema(ROWS).parquet(path)
    groups = max(1, rows.select(F.shiftright("row_key", RUN_BITS)).distinct().count())
    anchors = rows.where(F.col("id") % divisor == 0)
    windows = F.lit(None).cast("array<struct<place:int,id:bigint,score:bigint>>").alias("windows")
    path = scratch_path(spark, "positives")
    _first(_meet(rows, anchors.select("*", windows), groups, len(refs), _positives), POSITIVES).write.parquet(path)
    windows = (spark.read.parquet(path).groupBy("anchor_key")
               .agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("row_id").alias("id"), "score"))).alias("windows"))
               .withColumnRenamed("anchor_key", "row_key"))
    path = scratch_path(spark, "windows")
    anchors.join(windows, "row_key").write.parquet(path)
    anchors = spark.read.parquet(path)
    negatives = _first(_meet(rows, anchors, groups, len(refs), _negatives), NEGATIVES)
    known = anchors.select(F.col("row_key").alias("anchor_key"), F.col("id").alias("anchor_id"), F.inline("windows").alias("place", "positive_id", "positive_score"))
    return known.join(negatives.withColumnRenamed("row_id", "negative_id").withColumnRenamed("score", "negative_score"), ["anchor_key", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mines all of ``embeddings``; where 7 divides the id, the label is first moved to (label + 1) % 10."""
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(integer_vectors(documents(spark, sf_dir, "embeddings")).withColumn("label", moved))


ORACLE = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS place,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, b.place, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.vector, b.vector)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.place <> b.place WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor, anchor_id, place, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, place) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor, p.place ORDER BY score DESC, vec_id, s.place)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s USING (anchor, anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
