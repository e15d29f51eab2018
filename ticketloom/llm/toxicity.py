"""Toxicity by class-conditional Kneser-Ney models.

A byte n-gram model per class, over lower-cased text with single spaces.  The highest order
counts each class's n-grams (absolute discount); what it discounts goes to one lower-order
Kneser-Ney model that both classes share, built from continuation counts of the n-grams of
either class, so that an expression rare in one class is smoothed alike in both.  A document's
score is calibrated from the difference of its two log-likelihoods per byte, over the whole text
and over its most telling positions (the ``1 / PEAK`` of them with the largest ratios), for a few
toxic words in a long text.  The calibration is fitted on rows scored by a model of the other half
of the labelled rows; the final model counts them all.

Counts cover all labelled rows that aren't held out, and whole texts.  Scoring looks up, for
each position, the log ratio of its n-gram, or of the two discounts of its context if no class
has the n-gram.  These ratios stay a table, dealt out by a hash of the context: batches of texts
send their distinct n-grams to the hash ranges and get the ratios back, so every n-gram counts
however many there are, and nothing of the table goes to the driver or to all executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.llm.calibration import apply_logistic, fit_logistic
from ticketloom.llm.common import (
    TEXTS, batch_texts, chained, documents, each_row, held_out, materialize, narrow_input, prepare, text_batches)

ORDER, DISCOUNT = 4, 0.75
PEAK = 50                                 # one in so many positions makes the peak
BATCH_BYTES = 16_000_000                  # of text that looks up its n-grams at once
PART_BYTES, PART_GRAMS, LEAST_PARTS = 64_000_000, 1 << 19, 64     # of text, and n-grams, for each hash range
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.7
STEP = 1 << 18                            # bytes of text worked on at a time


def plain(text: str | bytes) -> bytes:
    data = text if isinstance(text, bytes) else text.encode()
    return b" " + b" ".join(data.lower().split()) + b" "


def grams(data: bytes, order: int) -> np.ndarray:
    """Each position's n-gram of ``order`` bytes as an integer; ``order - 1`` spaces stand before."""
    a = np.frombuffer(b" " * (order - 1) + data, np.uint8).astype(np.int64)
    out = np.zeros(len(data), np.int64)
    for k in range(order):
        out = (out << 8) | a[k:k + len(data)]
    return out


def blocks(texts, order: int):
    """``(numbers of the texts, their lengths, all their n-grams)``, about ``STEP`` bytes at a time;
    a long text comes in several blocks, with nothing lost between them."""
    numbers, sizes, found, total = [], [], [], 0
    for number, text in enumerate(texts):
        data = plain(text)
        for k in range(0, len(data), STEP):
            part = data[k:k + STEP]
            key = grams(part, order) if not k else grams(data[k - order + 1:k] + part, order)[order - 1:]
            numbers.append(number)
            sizes.append(len(part))
            found.append(key)
            total += len(part)
            if total >= STEP:
                yield np.array(numbers), np.array(sizes), np.concatenate(found)
                numbers, sizes, found, total = [], [], [], 0
    if total:
        yield np.array(numbers), np.array(sizes), np.concatenate(found)


def _count(order):
    def run(batches):
        held = {c: [] for c in range(4)}
        size = 0

        def merged():
            keys = np.unique(np.concatenate([k for c in held.values() for k, _ in c] or [np.empty(0, np.int64)]))
            counts = np.zeros((4, len(keys)), np.int64)
            for c, parts in held.items():
                for k, n in parts:
                    counts[c][np.searchsorted(keys, k)] += n
            return keys, counts

        def rows():
            keys, counts = merged()
            both = [counts[0] + counts[2], counts[1] + counts[3], counts[0], counts[1]]
            return pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, both)], ["gram", "n0", "n1", "h0", "h1"])

        for batch in batches:
            texts, classes = batch.column("text").to_pylist(), batch.column("y").to_pylist()
            for y in range(4):                 # the class, plus 2 in the half kept for calibration
                for _, _, keys in blocks([t for t, c in zip(texts, classes) if c == y], order):
                    held[y].append(np.unique(keys, return_counts=True))
                    size += len(held[y][-1][0])
            if size > 4_000_000:               # a bound on memory: what has been counted goes on
                yield rows()
                held, size = {c: [] for c in range(4)}, 0
        yield rows()
    return run


def _ratios(counts: DataFrame, order: int, discount: float) -> tuple[DataFrame, DataFrame]:
    """``(gram, ratio)`` of every n-gram and of every context of ``order - 1`` bytes."""
    def low(size):
        return (1 << (8 * size)) - 1

    kinds = counts.select(F.col("gram").alias("key"))
    levels = []
    for size in range(order - 1, 0, -1):       # continuation counts: distinct longer n-grams that end so
        kinds = kinds.groupBy(F.col("key").bitwiseAND(low(size)).alias("key")).agg(F.count("*").alias("cc"))
        levels.append((size, kinds))
        kinds = kinds.select("key", "cc")
    shared = None
    for size, level in reversed(levels):
        if size == 1:                          # at most 256 rows
            total = level.agg(F.sum("cc").alias("total"))
            shared = level.join(F.broadcast(total)).select("key", (F.col("cc") / F.col("total")).alias("p"))
            continue
        mine = Window.partitionBy(F.shiftright("key", 8))     # at most 256 rows each
        level = (level.withColumn("total", F.sum("cc").over(mine)).withColumn("types", F.count("*").over(mine))
                 .withColumn("tail", F.col("key").bitwiseAND(low(size - 1))))
        lower = shared.select(F.col("key").alias("tail"), F.col("p").alias("q"))
        shared = level.join(lower, "tail").select("key", (
            (F.greatest(F.col("cc") - discount, F.lit(0.0)) + discount * F.col("types") * F.col("q")) / F.col("total")).alias("p"))
    mine = Window.partitionBy("context")
    full = counts.withColumn("context", F.shiftright("gram", 8)).withColumn("tail", F.col("gram").bitwiseAND(low(order - 1)))
    for c in ("0", "1"):
        full = (full.withColumn("t" + c, F.sum("n" + c).over(mine))
                .withColumn("k" + c, F.count(F.when(F.col("n" + c) > 0, 1)).over(mine))
                .withColumn("l" + c, F.when(F.col("t" + c) > 0, discount * F.col("k" + c) / F.col("t" + c)).otherwise(F.lit(1.0))))
    full = full.join(shared.select(F.col("key").alias("tail"), "p"), "tail")
    for c in ("0", "1"):
        seen = F.when(F.col("t" + c) > 0, F.greatest(F.col("n" + c) - discount, F.lit(0.0)) / F.col("t" + c)).otherwise(F.lit(0.0))
        full = full.withColumn("p" + c, seen + F.col("l" + c) * F.col("p"))
    of_gram = full.select("gram", F.log(F.col("p1") / F.col("p0")).alias("ratio"))
    of_context = full.groupBy("context").agg(F.max(F.log(F.col("l1") / F.col("l0"))).alias("ratio"))
    return of_gram, of_context.withColumnRenamed("context", "gram")


def _part(contexts: np.ndarray, parts: int) -> np.ndarray:
    """Hash range of each context."""
    h = contexts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _dealt(parts, shift):
    """Ratios with their hash range; ``shift`` is 8 for n-grams and 0 for contexts."""
    def run(batches):
        for batch in batches:
            part = _part(batch.column("gram").to_numpy() >> shift, parts)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), shift > 0)), batch.column("gram"),
                                              batch.column("ratio")], ["part", "whole", "gram", "ratio"])
    return run


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(body: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(body), kind)


def _ask(order, parts):
    """``(part, batch, grams)`` of each batch of texts: its distinct n-grams by hash range."""
    def run(batches):
        for row in each_row(batches, ["batch", "sizes", "body"]):
            known, held, size = np.empty(0, np.int64), [], 0
            for _, _, keys in blocks(batch_texts(row), order):
                held.append(np.unique(keys))
                size += len(held[-1])
                if size > 4_000_000:
                    known, held, size = np.unique(np.concatenate([known, *held])), [], 0
            known = np.unique(np.concatenate([known, *held]))
            part = _part(known >> 8, parts)
            by = np.argsort(part, kind="stable")
            cells = np.split(known[by], np.flatnonzero(np.diff(part[by])) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.unique(part)), pa.array([row["batch"]] * len(cells), pa.int64()),
                 pa.array([_pack(c) for c in cells], pa.binary())], ["part", "batch", "grams"])
    return run


def _answer(asked: pa.Table, table: pa.Table) -> pa.Table:
    """``(batch, grams, ratios)``: each n-gram's ratio, or its context's, or zero."""
    whole = table.column("whole").to_numpy().astype(bool)
    grams_, ratio = table.column("gram").to_numpy(), table.column("ratio").to_numpy().astype(np.float32)

    def side(mask):
        by = np.argsort(grams_[mask])
        return np.append(grams_[mask][by], -1), np.append(ratio[mask][by], np.float32(0))

    (gram, of_gram), (context, of_context) = side(whole), side(~whole)
    ratios = []
    for body in asked.column("grams").to_pylist():
        keys = _unpack(body, np.int64)
        at, under = np.searchsorted(gram[:-1], keys), np.searchsorted(context[:-1], keys >> 8)
        ratios.append(_pack(np.where(gram[at] == keys, of_gram[at], np.where(context[under] == keys >> 8, of_context[under], np.float32(0)))))
    return pa.table({"batch": asked.column("batch"), "grams": asked.column("grams"), "ratios": pa.array(ratios, pa.binary())})


def _means(order):
    def run(batches):
        for row in each_row(batches, ["doc_ids", "sizes", "body", "found"]):
            found = row.pop("found") or []
            grams_ = np.concatenate([_unpack(x["grams"], np.int64) for x in found])
            by = np.argsort(grams_)
            grams_, ratios = grams_[by], np.concatenate([_unpack(x["ratios"], np.float32) for x in found])[by]
            total, size, peak = np.zeros((3, len(row["doc_ids"])))
            for number, sizes, keys in blocks(batch_texts(row), order):
                at = np.minimum(np.searchsorted(grams_, keys), len(grams_) - 1)
                if (grams_[at] != keys).any():
                    raise RuntimeError("the documents changed between two reads")
                value = ratios[at]
                np.add.at(total, number, np.add.reduceat(value.astype(np.float64), np.concatenate([[0], np.cumsum(sizes)[:-1]])))
                np.add.at(size, number, sizes)
                for i, part in zip(number.tolist(), np.split(value, np.cumsum(sizes)[:-1])):
                    top = -(-len(part) // PEAK)
                    peak[i] += len(part) * np.partition(part, len(part) - top)[len(part) - top:].mean(dtype=np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), *map(pa.array, (total / size, peak / size, np.log1p(size)))],
                                             ["doc_id", "m", "k", "n"])
    return run


def _looked_up(text: DataFrame, ratios: tuple[DataFrame, DataFrame], order: int, parts: int, batch_bytes: int) -> DataFrame:
    """``doc_id, m, k, n`` of each text: mean ratio, mean of the peak, log length."""
    kind = "part bigint, whole boolean, gram bigint, ratio double"
    of_gram, of_context = ratios
    table = of_gram.mapInArrow(_dealt(parts, 8), kind).unionByName(of_context.mapInArrow(_dealt(parts, 0), kind))
    asked = text.mapInArrow(chained(text_batches(batch_bytes), _ask(order, parts)), "part bigint, batch bigint, grams binary")
    found = (asked.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(_answer, "batch bigint, grams binary, ratios binary")
             .groupBy("batch").agg(F.collect_list(F.struct("grams", "ratios")).alias("found")))
    return (text.mapInArrow(text_batches(batch_bytes), TEXTS).join(found, "batch", "left")
            .mapInArrow(_means(order), "doc_id bigint, m double, k double, n double"))


def design(m: np.ndarray, k: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.column_stack([m, k, n, m * n, k * n, n * n])


def _score(model):
    def run(batches):
        for batch in batches:
            x = design(*(batch.column(c).to_numpy() for c in "mkn"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(apply_logistic(model, x))], ["doc_id", "score"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", order: int = ORDER, discount: float = DISCOUNT,
                    threshold: float = THRESHOLD, calibration_rows: int = CALIBRATION_ROWS,
                    batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``score`` says how likely label 1 is.

    Only labelled rows that aren't held out are learned from; a null label or id teaches
    nothing and a repeated id's labels count once (the largest).  Null and empty texts get the
    score of an empty text.  Without labels every score is 0.5; with one class only, its
    smoothed share.  ``docs`` is read more than once: it must be a scan of files, or checkpointed,
    so that a repeated read gives the same partitions."""
    prepare(docs.sparkSession)
    text = narrow_input(docs, id_col, text_col)
    known = materialize(labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
                        .groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(label_col).cast("int").alias("y")))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    taught = (text.where(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
              .join(known.withColumn("y", F.col("y") + 2 * half).hint("shuffle_hash"), "doc_id"))    # labels grow with the rows
    parts = "n0", "n1", "h0", "h1"
    counts = materialize(taught.mapInArrow(_count(order), "gram bigint, " + ", ".join(f"{c} bigint" for c in parts))
                         .groupBy("gram").agg(*(F.sum(c).alias(c) for c in parts)))

    taken = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-taken // PART_BYTES), -(-counts.count() // PART_GRAMS))

    def looked_up(texts, n0, n1):
        mine = counts.select("gram", F.col(n0).alias("n0"), F.col(n1).alias("n1")).where("n0 + n1 > 0")
        return _looked_up(texts, _ratios(mine, order, discount), order, parts, batch_bytes)

    sample = known.where(half == 1).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(calibration_rows)
    sample = materialize(sample)
    fit = (looked_up(text.join(F.broadcast(sample.select("doc_id")), "doc_id"), "h0", "h1")
           .join(F.broadcast(sample), "doc_id").toPandas())
    model = fit_logistic(design(*(fit[c].to_numpy(float) for c in "mkn")), fit["y"].to_numpy(float))
    scored = looked_up(text, "n0", "n1").mapInArrow(_score(model), "doc_id bigint, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
