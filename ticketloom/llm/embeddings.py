"""Embedding near-dedup by product quantisation.

Equal vectors of a label are collapsed first.  The distinct ones, scaled to length one, go to
coarse inverted lists, and their residuals to codes of a codebook per subspace; the centroids and
codebooks are fitted on a sample (``SAMPLE`` vectors, or four for each list if that is more), every
vector is indexed.  The lists are as many as half the root of the vectors.

For unit vectors, cosine >= t means distance <= d = sqrt(2 - 2t).  A vector probes each list whose
cell can hold a vector so near, so probes always suffice:  if y lies in the list of c and x in that
of a, |x-c|^2 - |x-a|^2 <= 2 d |c-a|.  In a list, asymmetric table-lookup distances to the codes
leave the vectors whose distance may be <= d given their own quantisation error, which is stored
with the code; so no link is lost there either.  What is left is reranked by the exact cosine.

A list over ``LIST_ROWS`` rows is split into parts, and its probes, if they are more, into blocks; every
part meets every block, so a group is bounded on both sides.  A task reports, for its group, the number of links of each vector and a forest of them, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import attach, documents, materialize, partition_id, prepare
from ticketloom.llm.components import components

THRESHOLD = 0.98
SAMPLE, SUBSPACES, CODES, ROUNDS = 20_000, 8, 256, 8
LIST_ROWS = 4096
SLACK = 1e-7           # for rounding; the exact cosine decides


def _vectors(batches):
    """Vectors as doubles in a binary; null where a vector can't link."""
    run = partition_id()
    for batch in batches:
        column, raw, digest = batch.column("embedding"), [], []
        for value in column:
            v = None if not value.is_valid else value.values
            data = None
            if v is not None and len(v) and not v.null_count:
                a = np.asarray(v.cast(pa.float64())) + 0.0          # -0.0 and 0.0 are equal
                scale = np.abs(a).max()
                if np.isfinite(a).all() and scale > 0:
                    data = a.astype("<f8").tobytes()
            raw.append(data)
            digest.append(None if data is None else xxhash.xxh3_128_digest(data))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array([run] * len(raw), pa.int64()), pa.array(raw, pa.binary()),
             pa.array(digest, pa.binary())], ["vec_id", "label", "run", "vec", "digest"])


def unit(raw: list[bytes]) -> np.ndarray:
    a = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    a = a / np.abs(a).max(axis=1, keepdims=True)
    return a / np.sqrt((a * a).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector."""
    step = max(1, (1 << 22) // len(c))
    return np.concatenate([_distances(x[k:k + step], c).argmin(1) for k in range(0, len(x), step)] or [np.empty(0, np.int64)])


def n_lists(n_vectors: int) -> int:
    return max(1, round(n_vectors ** 0.5 / 2))


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = nearest(x, c)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def fit(x: np.ndarray, n_vectors: int) -> dict:
    """Centroids and one codebook per subspace, of unit vectors of one dimension."""
    centroids = kmeans(x, n_lists(n_vectors), 1)
    residual = x - centroids[nearest(x, centroids)]
    cuts = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int)
    books = [kmeans(residual[:, a:b], CODES, 2 + k) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return {"centroids": centroids, "cuts": cuts, "books": books}


def encode(model: dict, x: np.ndarray):
    """List, code and quantisation error of each vector."""
    own = nearest(x, model["centroids"])
    residual = x - model["centroids"][own]
    codes, error = np.empty((len(x), len(model["books"])), np.uint8), np.zeros(len(x))
    for k, (a, b, book) in enumerate(zip(model["cuts"], model["cuts"][1:], model["books"])):
        codes[:, k] = nearest(residual[:, a:b], book)
        error += ((residual[:, a:b] - book[codes[:, k]]) ** 2).sum(1)
    return own, codes, np.sqrt(error)


def probes(model: dict, x: np.ndarray, own: np.ndarray, reach: float):
    """``(vector, list)`` of the lists from the own one on that may hold a vector within reach.
    (The lists before it probe this one.)"""
    c = model["centroids"]
    d = _distances(x, c)
    gap = np.sqrt(_distances(c[own], c))
    near = d - d[np.arange(len(x)), own][:, None] <= 2 * reach * gap + SLACK
    near[np.arange(len(x)), own] = True
    near &= np.arange(len(c))[None, :] >= own[:, None]
    return np.nonzero(near)


def _indexed(models):
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                own, codes, error = encode(models.value[int(dim)], unit(part.column("vec").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), part.column("dim"), pa.array(own.astype(np.int64)), part.column("node"), part.column("n"),
                     part.column("vec"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                    ["label", "dim", "list", "node", "n", "vec", "code", "error"])
    return run


def _probing(models, reach, places_only=False):
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for k in range(0, part.num_rows, 512):
                    rows = part.slice(k, 512)
                    x = unit(rows.column("vec").to_pylist())
                    i, lists = probes(models.value[int(dim)], x, rows.column("list").to_numpy(), reach)
                    if places_only:
                        yield rows.select(["label", "dim"]).take(pa.array(i)).append_column("list", pa.array(lists.astype(np.int64)))
                        continue
                    yield rows.select(["label", "dim", "node", "n", "vec"]).take(pa.array(i)).append_column(
                        "probe", rows.column("list").take(pa.array(i))).append_column("list", pa.array(lists.astype(np.int64)))
    return run


def _linked(models, threshold, reach):
    def run(key, base: pa.Table, probe: pa.Table) -> pa.Table:
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        if not base.num_rows or not probe.num_rows:
            return empty
        dim, number = key[1].as_py(), key[2].as_py()
        model = models.value[dim]
        y, node_y, n_y = unit(base.column("vec").to_pylist()), base.column("node").to_numpy(), base.column("n").to_numpy()
        codes = np.frombuffer(b"".join(base.column("code").to_pylist()), np.uint8).reshape(len(y), -1)
        limit = (reach + base.column("error").to_numpy() + SLACK) ** 2
        raw_y = np.frombuffer(b"".join(base.column("vec").to_pylist()), "<f8").reshape(len(y), -1)
        node_x, n_x = probe.column("node").to_numpy(), probe.column("n").to_numpy()
        home = probe.column("probe").to_numpy() == number
        places = {int(v): k for k, v in enumerate(np.unique(np.concatenate([node_x, node_y])).tolist())}
        nodes = np.array(list(places), np.int64)
        links, parent, forest = np.zeros(len(nodes), np.int64), list(range(len(nodes))), ([], [])

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        at_y = np.array([places[int(v)] for v in node_y])
        for k in range(0, len(node_x), 256):
            raw = probe.column("vec").slice(k, 256).to_pylist()
            x = unit(raw) - model["centroids"][number]
            near = np.zeros((len(x), len(y)))
            for m, (a, b, book) in enumerate(zip(model["cuts"], model["cuts"][1:], model["books"])):
                near += _distances(x[:, a:b], book)[:, codes[:, m]]         # the lookup table of each probe
            keep = near <= limit[None, :] + SLACK
            keep &= ~home[k:k + 256, None] | (node_x[k:k + 256, None] < node_y[None, :])
            i, j = np.nonzero(keep)
            if not len(i):
                continue
            raw_x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
            cosine = np.empty(len(i))
            for s in range(0, len(i), 65536):
                p, q = raw_x[i[s:s + 65536]], raw_y[j[s:s + 65536]]
                p, q = p / np.abs(p).max(1, keepdims=True), q / np.abs(q).max(1, keepdims=True)
                cosine[s:s + 65536] = (p * q).sum(1) / np.sqrt((p * p).sum(1) * (q * q).sum(1))
            i, j = i[cosine >= threshold] + k, j[cosine >= threshold]
            at_x = np.array([places[int(v)] for v in node_x[i]], np.int64)
            np.add.at(links, at_x, n_y[j])
            np.add.at(links, at_y[j], n_x[i])
            for a, b in zip(at_x.tolist(), at_y[j].tolist()):
                ra, rb = root(a), root(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    forest[0].append(a)
                    forest[1].append(b)
        some = np.flatnonzero(links)
        return pa.table({"a": pa.array(np.concatenate([nodes[some], nodes[forest[0]] if forest[0] else np.empty(0, np.int64)])),
                         "b": pa.array([None] * len(some) + (nodes[forest[1]].tolist() if forest[1] else []), pa.int64()),
                         "links": pa.array(np.concatenate([links[some], np.zeros(len(forest[0]), np.int64)]))})
    return run


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, sample: int = SAMPLE, list_rows: int = LIST_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link if their labels are equal and not null and the cosine of their vectors is at least
    ``threshold`` (over 0); vectors of different lengths, and null, empty, zero or partly null or
    non-finite ones, link with nothing.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable and ``kept`` says that it is the row's own.
    Repeated rows link with each other; null ids are never a component's smallest unless it holds
    no other, and never kept.  Extra columns are left out."""
    spark = vectors.sparkSession
    prepare(spark)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    plain = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"),
                           F.col(label_col).cast("string").alias("label"))
    rows = plain.mapInArrow(_vectors, "vec_id bigint, label string, run bigint, vec binary, digest binary")
    rows = materialize(rows.withColumn("key", F.when(F.col("label").isNotNull() & F.col("vec").isNotNull(),
                                                     F.struct("label", "digest"))))
    single = rows.where("key IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    rows = rows.where("key IS NOT NULL")
    equal = (rows.groupBy("key", "run").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"), F.min("vec").alias("vec"))
             .groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.min("vec").alias("vec")))
    distinct = materialize(equal.select(F.monotonically_increasing_id().alias("node"), "key", F.col("key.label").alias("label"), "n",
                                        "low", "vec", F.floor(F.length("vec") / 8).cast("bigint").alias("dim")))
    # a dimension's model is bounded; so many dimensions that their models are not, are not expected of one column
    sizes = {r["dim"]: r["count"] for r in distinct.groupBy("dim").count().collect()}
    models = {}
    for dim, size in sizes.items():
        taken = distinct.where(F.col("dim") == dim).orderBy(F.xxhash64("key"), "node").limit(max(sample, 4 * n_lists(size))).select("vec").collect()
        models[dim] = fit(unit([bytes(r["vec"]) for r in taken]), size)
    models = spark.sparkContext.broadcast(models)
    base = materialize(distinct.select("label", "dim", "node", "n", "vec").mapInArrow(
        _indexed(models), "label string, dim bigint, list bigint, node bigint, n bigint, vec binary, code binary, error double"))
    place = ["label", "dim", "list"]
    parts = base.groupBy(*place).agg(F.ceil(F.count("*") / list_rows).cast("bigint").alias("parts"))
    blocks = (base.mapInArrow(_probing(models, reach, places_only=True), "label string, dim bigint, list bigint")
              .groupBy(*place).agg(F.ceil(F.count("*") / list_rows).cast("bigint").alias("blocks")))
    cells = materialize(parts.join(blocks, place))
    # a list's part p and block q of its probes meet in the group (list, p, q)
    spread = (base.join(cells, place).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("parts", "blocks"))
    probe = (base.mapInArrow(_probing(models, reach), "label string, dim bigint, node bigint, n bigint, vec binary, probe bigint, list bigint")
             .join(cells, place).withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "blocks"))
    keys = [*place, "part", "block"]
    found = materialize(spread.groupBy(*keys).cogroup(probe.groupBy(*keys)).applyInArrow(
        _linked(models, threshold, reach), "a bigint, b bigint, links bigint"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "node")
    of = distinct.join(joined, "node", "left").join(links, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of = of.withColumn("spread", F.pmod(F.xxhash64("node"), F.lit(64)))
    lows = of.groupBy("component", "spread").agg(F.min("low").alias("low")).groupBy("component").agg(F.min("low").alias("component_id"))
    table = attach(of, lows, "component", "spread").select(
        "key", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = attach(rows, table, "key", "run").select("vec_id", "n_links", "component_id")
    return linked.unionByName(single).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(documents(spark, sf_dir, "embeddings"))
