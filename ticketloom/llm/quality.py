"""Quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled text.  A document is
compressed in whole, chunk by chunk, with either; the normalised difference of the two sizes
(with the size per byte and the length, which tell how much the difference can say) becomes a
calibrated score.  Fitting uses at most ``dictionary_rows`` labelled rows per class for the
dictionaries and ``calibration_rows`` others for the calibration; scoring covers every row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.calibration import apply_logistic, fit_logistic
from ticketloom.llm.common import documents, held_out, materialize, narrow_input, prepare

CHUNK, LEVEL, DICT_BYTES = 512, 3, 112_640
DICTIONARY_ROWS, CALIBRATION_ROWS = 1500, 20_000
SAMPLES, SAMPLE_BYTES = 12_000, 8_000_000      # chunks per class that a dictionary is trained on


def _dictionary(texts: list[str]) -> bytes:
    """Dictionary content from chunks of the texts, taken in turn from all parts of each."""
    chunks, size, turn = [], 0, 0
    parts = [(b := t.encode(), max(1, -(-len(b) // CHUNK))) for t in texts]
    while len(chunks) < SAMPLES and size < SAMPLE_BYTES and any(turn < n for _, n in parts):
        for b, n in parts:
            if turn < n:
                at = (turn * 7919 % n) * CHUNK if n % 7919 else turn * CHUNK   # all chunks, in scattered order
                chunks.append(b[at:at + CHUNK])
                size += len(chunks[-1])
        turn += 1
    chunks = [c for c in chunks if c][:SAMPLES]
    try:
        return zstandard.train_dictionary(DICT_BYTES, chunks).as_bytes()
    except zstandard.ZstdError:                # too little text to train on: use the text itself
        return b"".join(chunks)[-DICT_BYTES:]


def _own_lines(taught: list[tuple]) -> list[tuple]:
    """The taught texts without the lines that several different ones share: a passage found in many
    documents tells nothing about the class of one, however well a dictionary holds it."""
    seen: dict[str, int] = {}
    for text in {t for _, _, t in taught}:
        for line in set(text.split("\n")):
            seen[line] = seen.get(line, 0) + 1
    return [(y, i, "\n".join(x for x in t.split("\n") if seen[x] == 1)) for y, i, t in taught]


def _compressor(content: bytes):
    kind = zstandard.DICT_TYPE_AUTO
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(content) < 8:
        return zstandard.ZstdCompressor(**options)
    data = zstandard.ZstdCompressionDict(content, dict_type=kind)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **options)


def features(text: str, bad, good) -> tuple[float, float, float]:
    """Normalised difference, bytes of the better-text compression per byte, log length."""
    b = text.encode()
    if not b:
        return 0.0, 1.0, 0.0
    chunks = [b[k:k + CHUNK] for k in range(0, len(b), CHUNK)]
    with_bad = sum(len(bad.compress(c)) for c in chunks)
    with_good = sum(len(good.compress(c)) for c in chunks)
    return (with_bad - with_good) / (with_bad + with_good), with_good / len(b), float(np.log1p(len(b)))


def _features(dictionaries):
    def run(batches):
        bad, good = (_compressor(c) for c in dictionaries.value)
        for batch in batches:
            rows = np.array([features(t, bad, good) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), *(pa.array(rows[:, k]) for k in range(3))],
                                             [*keep, "d", "r", "n"])
    return run


def design(d: np.ndarray, r: np.ndarray, n: np.ndarray) -> np.ndarray:
    r = np.minimum(r, 2.0)
    return np.column_stack([d, d * d, r, r * r, n, n * n, d * r, d * n, r * n])


def _score(model):
    def run(batches):
        for batch in batches:
            x = design(*(batch.column(c).to_numpy() for c in "drn"))
            keep = [c for c in batch.schema.names if c not in "drn"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(apply_logistic(model, x))], [*keep, "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", dictionary_rows: int = DICTIONARY_ROWS,
                   calibration_rows: int = CALIBRATION_ROWS, row_col: str | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``score`` says how likely label 1 is.

    Only labelled rows that aren't held out are learned from; a null label or id teaches
    nothing and a repeated id's labels count once (the largest).  The score depends on the
    text alone: null and empty texts get the score of an empty text, repeated rows the same
    score.  Without labels every score is 0.5; with one class only, its smoothed share.
    ``row_col`` names a unique bigint column to be returned as ``row``, first."""
    spark = docs.sparkSession
    prepare(spark)
    text = narrow_input(docs, id_col, text_col, row_col)
    own = "row bigint, doc_id bigint" if row_col else "doc_id bigint"
    known = materialize(labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
                        .groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(label_col).cast("int").alias("y")))
    order = F.xxhash64("doc_id")
    known = known.withColumn("even", F.pmod(order, F.lit(2)) == 0)      # one half for either use
    chosen = [known.where((F.col("y") == y) & F.col("even")).orderBy(order, "doc_id").limit(dictionary_rows).drop("even")
              for y in (0, 1)]
    chosen = materialize(chosen[0].unionByName(chosen[1]))
    # at most 2 * dictionary_rows ids, so this side is always small enough to broadcast
    taught = sorted(map(tuple, text.join(F.broadcast(chosen), "doc_id").select("y", "doc_id", "text")
                        .dropDuplicates(["doc_id"]).collect()))
    taught = _own_lines(taught)
    dictionaries = spark.sparkContext.broadcast([_dictionary([t for c, _, t in taught if c == y]) for y in (0, 1)])
    rows = materialize(text.mapInArrow(_features(dictionaries), f"{own}, d double, r double, n double"))
    sample = known.where(~F.col("even")).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(calibration_rows)
    fit = rows.join(F.broadcast(sample.drop("even")), "doc_id").select("y", "d", "r", "n").toPandas()
    model = fit_logistic(design(*(fit[c].to_numpy(float) for c in "drn")), fit["y"].to_numpy(float))
    scored = rows.mapInArrow(_score(model), f"{own}, score double")
    return scored.select(*(["row"] if row_col else []), "doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
