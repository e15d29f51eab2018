"""Packing by lexical retrieval.

Documents become token ids once, in a table of the shared folder.  The BM25 index is sharded, and
documents are dealt to shards by content, not by where they were stored: a tree over sketches of their
weighted terms, fitted on a bounded sample, puts them in an order in which alike ones are near, and a
shard is a bounded run of it.  A corpus of one shard is searched whole.  A shard has the postings of its
own documents and the document frequencies of the whole corpus (at most one number per vocabulary
entry); a query is all terms of its seed.  In a shard every window starts with the longest unused document as its seed; the index returns the seed's
unused neighbours, which fill the window by rank, and the best one that doesn't fit is cut to
fill it exactly.  Only what is left at the end of a shard is shorter than a window, and it is cut
at powers of two, which need no padding.
"""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import documents, narrow_input, partition_id, prepare
from ticketloom.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
WINDOW, END_ID = 2048, 1
SHARD_TOKENS, SHARD_DOCS = 4_000_000, 8192     # what a shard's index holds; not a limit on documents
SEEDS = 64                                     # queries answered at once
SKETCH, SAMPLE, LEVELS = 128, 8192, 12         # dimensions of a sketch, documents that the tree is fitted on, its depth
K1, B = 1.2, 0.75
PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")

_ENCODERS: dict[int, tiktoken.Encoding] = {}


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file whose ids are in merge order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    model = json.load(open(path, encoding="utf-8"))
    special = {t["content"] for t in model.get("added_tokens", [])}
    return {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}


def _encoder(ranks, pattern) -> tiktoken.Encoding:
    key = hash((len(ranks), pattern, min(ranks), max(ranks.values())))
    if key not in _ENCODERS:
        _ENCODERS[key] = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def _with_end(ids: list[int], end_id: int) -> np.ndarray:
    ids.append(end_id)
    return np.fromiter(ids, "<u4", len(ids))


def _tokens(shared, end_id):
    def run(batches):
        encode = _encoder(*shared.value).encode_ordinary
        for batch in batches:
            table = [_with_end(encode(text), end_id) for text in batch.column("text").to_pylist()]
            wide = any(x.max() > 0xFFFF for x in table)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x.tobytes() if wide else x.astype("<u2").tobytes() for x in table], pa.binary()),
                 pa.array([wide] * len(table), pa.bool_())], ["doc_id", "ids", "wide"])
    return run


def _ids(batch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4" if w else "<u2").astype(np.uint32)
            for x, w in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist())]


def _distinct_terms(ids: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The distinct ids, by writing each one's place into ``room`` (as long as the vocabulary): the last stays."""
    places = np.arange(len(ids))
    room[ids] = places
    return ids[room[ids] == places]


def _frequencies(size):
    def run(batches):
        df, room, docs, total = np.zeros(size, np.int64), np.empty(size, np.int64), 0, 0
        for batch in batches:
            for ids in _ids(batch):
                df[_distinct_terms(ids, room)] += 1
                docs += 1
                total += len(ids)
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([terms, [-1, -2]])), pa.array(np.concatenate([df[terms], [docs, total]]))], ["term", "n"])
    return run


class Shard:
    """BM25 postings of some documents, and which of them are unused.

    A query is all distinct terms of its document.  Terms that an eighth of the documents hold are kept as
    columns of a matrix, which a batch of queries multiplies; the others as postings."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float):
        n = len(ids)
        length = np.array([len(x) for x in ids], np.float64)
        doc = np.repeat(np.arange(n, dtype=np.int64), length.astype(np.int64))
        key, tf = np.unique((np.concatenate(ids).astype(np.int64) << 32) | doc, return_counts=True)
        doc, term = key & 0xFFFFFFFF, key >> 32
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / mean_length))
        df = np.bincount(term, minlength=len(idf))
        often = np.flatnonzero(df * 8 >= n)
        column = np.full(len(idf), -1, np.int64)
        column[often] = np.arange(len(often))
        dense = column[term] >= 0
        self.matrix = np.zeros((len(often), n), np.float32)
        self.matrix[column[term[dense]], doc[dense]] = weight[dense]
        order = np.argsort(doc, kind="stable")                 # terms by document
        self.own, self.own_first = term[order], np.searchsorted(doc[order], np.arange(n + 1))
        self.column = column
        self.doc, self.weight, term = doc[~dense], weight[~dense], term[~dense]
        self.first = np.searchsorted(term, np.arange(len(idf) + 1))
        self.n = n

    def scores(self, seeds: list[int]) -> list[np.ndarray]:
        """For each seed the BM25 score of every document of the shard."""
        query = np.zeros((len(seeds), len(self.matrix)), np.float32)
        rare = []
        for k, seed in enumerate(seeds):
            terms = self.own[self.own_first[seed]:self.own_first[seed + 1]]
            columns = self.column[terms]
            query[k, columns[columns >= 0]] = 1
            rare.append(terms[columns < 0])
        out = list((query @ self.matrix).astype(np.float64))
        for k, terms in enumerate(rare):
            spans = [(a, b) for a, b in zip(self.first[terms].tolist(), self.first[terms + 1].tolist()) if b > a + 1]    # not the seed alone
            if spans:
                docs = np.concatenate([self.doc[a:b] for a, b in spans])
                out[k] += np.bincount(docs, np.concatenate([self.weight[a:b] for a, b in spans]), minlength=self.n)
        return out

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first, ties by place."""
        return np.concatenate([np.zeros(0, np.int64), *self.ranked(self.scores([seed])[0], unused)])

    @staticmethod
    def ranked(score: np.ndarray, unused: np.ndarray):
        """The unused documents with a score, best first, ties by place: the first ones, and then the rest."""
        score = np.where(unused, score, 0)
        found = np.flatnonzero(score)
        if len(found) > 64:                                    # mostly the first ones suffice
            high = score[found] > np.partition(score[found], len(found) - 64)[len(found) - 64]
            top, found = found[high], found[~high]
            yield top[np.lexsort((top, -score[top]))]
        yield found[np.lexsort((found, -score[found]))]


class Scores:
    """Scores of seeds, computed for the next ``SEEDS`` unused ones at once."""

    def __init__(self, shard: Shard, order: list[int]):
        self.shard, self.order, self.at, self.known = shard, order, 0, {}

    def of(self, seed: int, unused: np.ndarray) -> np.ndarray:
        if seed not in self.known:
            while self.at < len(self.order) and self.order[self.at] != seed:
                self.at += 1
            batch = [seed]
            for d in self.order[self.at + 1:]:
                if len(batch) == SEEDS:
                    break
                if unused[d]:
                    batch.append(d)
            self.known = dict(zip(batch, self.shard.scores(batch)))
        return self.known.pop(seed)


def pack(ids: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int):
    """Yield each sequence as a list of ``(document's place, start, length)``."""
    start = np.zeros(len(ids), np.int64)
    left = np.array([len(x) for x in ids], np.int64)
    for d in np.flatnonzero(left >= window).tolist():          # a long document fills windows itself
        while left[d] >= window:
            yield [(d, int(start[d]), window)]
            start[d] += window
            left[d] -= window
    unused = left > 0
    if not unused.any():
        return
    shard = Shard(ids, idf, mean_length)
    by_size = np.argsort(-left, kind="stable")
    seeds, scores = iter(by_size.tolist()), Scores(shard, by_size.tolist())
    spare = by_size[::-1].tolist()                             # the shortest at the end's other side
    left_least = int(left[unused].min())
    while True:
        seed = next((d for d in seeds if unused[d]), None)
        if seed is None:                                       # only remainders of cut documents may be left
            rest = np.flatnonzero(unused)
            if not len(rest):
                return
            seed = int(rest[0])
        line, room = [(seed, int(start[seed]), int(left[seed]))], window - int(left[seed])
        unused[seed] = False
        cut = -1
        if room:
            for best in shard.ranked(scores.of(seed, unused), unused):
                sizes, at = left[best], 0
                while room:                                    # the next one that fits
                    fits = np.flatnonzero(sizes[at:] <= room)
                    if cut < 0 and at < len(best) and not (len(fits) and fits[0] == 0):
                        cut = int(best[at])
                    if not len(fits):
                        break
                    at += int(fits[0])
                    d = int(best[at])
                    line.append((d, int(start[d]), int(left[d])))
                    room -= int(left[d])
                    unused[d] = False
                    at += 1
                if not room or room < left_least:
                    break
        while room and (cut >= 0 or unused.any()):             # cut the best neighbour, or whatever is unused
            if cut < 0 or not unused[cut]:
                while spare and not unused[spare[-1]]:
                    spare.pop()
                cut = spare[-1] if spare else int(np.flatnonzero(unused)[0])
            n = min(room, int(left[cut]))
            line.append((cut, int(start[cut]), n))
            start[cut] += n
            left[cut] -= n
            room -= n
            unused[cut] = left[cut] > 0
            cut = -1
        if not room:
            yield line
            continue
        size = window - room                                   # the shard's end
        for bit in reversed(range(size.bit_length())):
            if size >> bit & 1:
                part, room = [], 1 << bit
                while room:
                    d, s, n = line.pop(0)
                    take = min(n, room)
                    part.append((d, s, take))
                    room -= take
                    if take < n:
                        line.insert(0, (d, s + take, n - take))
                yield part


def _packed(shared, window, shard_tokens, shard_docs):
    def sequences(docs, ids, number):
        idf, mean_length = shared.value
        out = [[] for _ in range(7)]
        for line in pack(ids, idf, mean_length, window):
            offset = 0
            for d, s, n in line:
                for column, value in zip(out, (docs[d], s, n, ids[d][s:s + n].astype("<u4").tobytes(), len(ids[d]), number, offset)):
                    column.append(value)
                offset += n
            number += 1
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for k in range(0, len(out[0]), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c[k:k + 4096], pa.binary() if n == "ids" else pa.int64())
                                              for n, c in zip(names, out)], names)

    def run(batches):
        docs, ids, size, number, now = [], [], 0, partition_id() << 36, None
        for batch in batches:
            for i, x, shard in zip(batch.column("doc_id").to_pylist(), _ids(batch), batch.column("shard").to_pylist()):
                # shards are about as large as planned; one that came out larger is cut
                if ids and (shard != now or 2 * size >= 3 * shard_tokens or 2 * len(ids) >= 3 * shard_docs):
                    yield from sequences(docs, ids, number)
                    number += size + 1                         # a shard has fewer sequences than tokens
                    docs, ids, size = [], [], 0
                now = shard
                docs.append(i)
                ids.append(x)
                size += len(x)
        if ids:
            yield from sequences(docs, ids, number)
    return run


class Sketcher:
    """A document's terms, weighted by rarity and hashed with signs to ``SKETCH`` numbers, of length 1."""

    def __init__(self, idf: np.ndarray):
        h = (np.arange(len(idf), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        self.signed = np.where((h >> np.uint64(40)) & np.uint64(1), idf, -idf)
        self.slot, self.room = (h >> np.uint64(50)).astype(np.int64) % SKETCH, np.empty(len(idf), np.int64)

    def of(self, documents: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(documents), SKETCH))
        for k, ids in enumerate(documents):
            terms = _distinct_terms(ids, self.room)
            out[k] = np.bincount(self.slot[terms], self.signed[terms], minlength=SKETCH)
        norms = np.linalg.norm(out, axis=1)
        return out / np.where(norms > 0, norms, 1)[:, None]


def _gap(values: np.ndarray) -> float:
    """A value between two different ones, next to the median; the greatest if all are alike."""
    if not len(values):
        return 0.0
    values = np.sort(values)
    gaps = np.flatnonzero(np.diff(values) > 1e-6)
    if not len(gaps):
        return float(values[-1]) + 1e-6
    k = gaps[np.abs(gaps + 1 - len(values) / 2).argmin()]
    return float(values[k] + values[k + 1]) / 2


def fit_tree(sample: np.ndarray, levels: int) -> list:
    """For each inner node of a binary tree ``(direction, threshold)``: sketches are halved between two poles of
    their own, at the gap next to the median, so that copies stay on one side however they are rounded.  Node k has children 2 k + 1 and 2 k + 2."""
    nodes, rows = [], {0: sample}
    for k in range(2 ** levels - 1):
        x = rows.pop(k)
        direction = np.zeros(SKETCH)
        if len(x) > 1:
            a = x[int(np.linalg.norm(x - x.mean(axis=0), axis=1).argmax())]
            b = x[int(np.linalg.norm(x - a, axis=1).argmax())]
            for _ in range(5):                                # two means, from two far rows
                near = np.linalg.norm(x - a, axis=1) <= np.linalg.norm(x - b, axis=1)
                if near.all() or not near.any():
                    break
                a, b = x[near].mean(axis=0), x[~near].mean(axis=0)
            direction = b - a
        side = x @ direction if len(x) else np.zeros(0)
        threshold = _gap(side)
        nodes.append((direction, threshold))
        rows[2 * k + 1], rows[2 * k + 2] = x[side <= threshold], x[side > threshold]
    return nodes


def _sampled(model):
    def run(batches):
        sketcher = Sketcher(model.value)
        for batch in batches:
            rows = sketcher.of(_ids(batch)).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array([x.tobytes() for x in rows], pa.binary())], ["place", "sketch"])
    return run


def _leaf(x: np.ndarray, nodes: list, levels: int) -> np.ndarray:
    """Leaf, from 0, of each sketch."""
    directions, thresholds = np.array([d for d, _ in nodes]), np.array([t for _, t in nodes])
    k = np.zeros(len(x), np.int64)
    for _ in range(levels):
        k = 2 * k + 1 + (np.einsum("ij,ij->i", x, directions[k]) > thresholds[k])
    return k - (2 ** levels - 1)


def _dealt(model, levels, shards):
    def run(batches):
        idf, nodes, first, share = model.value
        sketcher = Sketcher(idf)
        for batch in batches:
            leaf = _leaf(sketcher.of(_ids(batch)), nodes, levels)
            within = (batch.column("place").to_numpy().view(np.uint64) >> np.uint64(11)) / 2.0 ** 53
            shard = np.minimum(((first[leaf] + share[leaf] * within) * shards).astype(np.int64), shards - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], [*batch.schema.names, "shard"])
    return run


def by_content(tokens: DataFrame, idf: np.ndarray, n_tokens: int, shard_tokens: int, n_docs: int, shard_docs: int) -> DataFrame:
    """``tokens`` with their ``shard``, and sorted by it in partitions that hold whole shards.

    The leaves of the tree stand in their order on a line, each as wide as its share of the sample, and a
    shard is a stretch of the line; inside a leaf documents are spread by a hash of their place, so a
    text that a third of the rows hold fills as many shards as it needs."""
    spark = tokens.sparkSession
    shards = max(1, -(-n_tokens // shard_tokens), -(-n_docs // shard_docs))
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("place")
    tokens = tokens.select("doc_id", "ids", "wide", place)
    if shards == 1:
        return tokens.withColumn("shard", F.lit(0).cast("bigint")).repartition(1).sortWithinPartitions("place").drop("place")
    # as many leaves as shards or a few more, at most 2^LEVELS
    levels = min(LEVELS, (shards - 1).bit_length() + 1)
    # about SAMPLE documents, by a hash of where they are; their sketches alone go to the driver
    least = -(1 << 63) + int(min(1.0, SAMPLE / n_docs) * ((1 << 64) - 1))
    weights = spark.sparkContext.broadcast(idf)
    sample = tokens.where(F.col("place") <= min(least, (1 << 63) - 1)).mapInArrow(_sampled(weights), "place bigint, sketch binary").collect()
    sample = np.array([np.frombuffer(r.sketch, "<f4") for r in sorted(sample, key=lambda r: r.place)], np.float64).reshape(len(sample), SKETCH)
    nodes = fit_tree(sample, levels)
    mass = np.bincount(_leaf(sample, nodes, levels), minlength=2 ** levels) + 0.5
    share = mass / mass.sum()
    model = spark.sparkContext.broadcast((idf, nodes, np.cumsum(share) - share, share))
    return (tokens.mapInArrow(_dealt(model, levels, shards), "doc_id bigint, ids binary, wide boolean, place bigint, shard bigint")
            .repartition(shards, "shard").sortWithinPartitions("shard", "place").drop("place"))


def pack_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id",
                   text_col: str = "text", window: int = WINDOW, end_id: int = END_ID,
                   shard_tokens: int = SHARD_TOKENS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers.  A document's ids are
    those of its text and ``end_id``, so null and empty texts are one id long.  Every id of every
    row, repeated rows and null ids included, is in exactly one piece; a sequence's offsets go from
    0 without a gap, and it is ``window`` long or, at the end of a shard, a power of two.  A seed's
    neighbours are those of its shard, of about ``shard_tokens`` tokens and ``shard_docs`` documents; a
    document of which many copies exist fills shards of its own."""
    spark = docs.sparkSession
    prepare(spark)
    size = max(max(ranks.values()), end_id) + 1
    shared = spark.sparkContext.broadcast((ranks, pattern))
    path = scratch_path(spark, "packing-ids")
    (narrow_input(docs, id_col, text_col).mapInArrow(_tokens(shared, end_id), "doc_id bigint, ids binary, wide boolean")
     .write.option("compression", "zstd").parquet(path))
    tokens = spark.read.parquet(path)
    # at most one row per vocabulary entry, whatever the corpus
    counted = tokens.mapInArrow(_frequencies(size), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(size, np.float64)
    inside = counted["term"] >= 0
    df[counted["term"][inside]] = counted["n"][inside]
    n_docs = max(1, int(counted["n"][counted["term"] == -1].sum()))
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
    mean_length = max(1.0, float(counted["n"][counted["term"] == -2].sum()) / n_docs)
    model = spark.sparkContext.broadcast((idf, mean_length))
    n_tokens = int(counted["n"][counted["term"] == -2].sum())
    return by_content(tokens, idf, n_tokens, shard_tokens, n_docs, shard_docs).mapInArrow(_packed(model, window, shard_tokens, shard_docs), PIECES)


def op6_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir), read_vocabulary(public_tokenizers.path(VOCABULARY)))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
