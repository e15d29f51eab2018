"""Substring dedup by fixed-block anchors.

A window of ``2b`` consecutive words holds, wherever it starts, a whole block of ``b`` words that
begins at a multiple of ``b`` in its document: the anchors.

1. Every document's non-overlapping blocks are indexed and every rolling window of ``b`` words
   probes them.  An anchor is hit if its words also stand anywhere else.
2. Hits are extended: a window of ``2b`` words can only repeat if all anchors inside it are hit,
   here and where it repeats.  Such windows form the maximal repeats; each is compared with all
   others of the same words, and the first in the order of ids and places is kept.
3. The words that later windows cover are removed.

Texts stay in batches of a few MB.  A batch sends its distinct window hashes to ``parts`` ranges
of the hash space and gets one bit back for each, so a passage that a third of the documents
share is one hash per batch, nothing is paired within a group, and what moves is a few bytes a
word.  A range's size is bounded because their number follows the input.  Probes carry 32 bits
beside the range (a false hit only makes a window be compared in vain); the windows compared at
last agree in 64 bits of one hash and the range's bits of another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import TEXTS, batch_texts, chained, documents, each_row, narrow_input, prepare, text_batches

WINDOW = 20
BATCH_BYTES = 3_000_000
PART_BYTES, LEAST_PARTS = 8_000_000, 64        # of text for each hash range; raise both with the memory of a task
NULL_ID = np.iinfo(np.int64).max               # null ids come last
A, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

CELL = "part bigint, batch bigint, body binary"
BITS = "batch bigint, part bigint, bits binary"


class _Hashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0x94D049BB133111EB) ^ (h >> np.uint64(31))


def _rolling(h: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    """Hash of the ``size`` words from each place on (places too near the end have none)."""
    n = max(0, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * factor + h[k:k + n]
    return _mix(out)


class Batch:
    """Word hashes of a batch's documents, one after the other, and its windows."""

    def __init__(self, row, window: int, parts: int, keep_words: bool = False):
        self.window, self.block, self.shift = window, window // 2, 64 - (parts.bit_length() - 1)
        self.ids, self.number = row["doc_ids"], row["batch"]
        words = [t.split() for t in batch_texts(row)]
        self.n = np.array([len(w) for w in words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.n)])
        known = _Hashes()
        self.h = np.fromiter((known[w] for ws in words for w in ws), np.uint64, int(self.start[-1]))
        self.words = words if keep_words else None
        del words, known
        kind = np.int32 if len(self.h) < 2 ** 31 else np.int64
        self.doc = np.repeat(np.arange(len(self.n), dtype=kind), self.n)
        self.place = np.arange(len(self.h), dtype=kind) - self.start.astype(kind)[self.doc]
        self.left = self.n.astype(kind)[self.doc] - self.place
        # rolling windows of a block's size, in documents that have a whole window
        self.probe = np.flatnonzero((self.left >= self.block) & (self.n >= window)[self.doc]).astype(kind)
        keys = _rolling(self.h, self.block, A)[self.probe] if len(self.probe) else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable").astype(kind)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        size = np.diff(np.concatenate([first, [len(keys)]]))
        self.keys, self.often = keys[first], size > 1
        anchor = (self.place[self.probe] % self.block == 0)[order]
        self.anchored = np.logical_or.reduceat(anchor, first) if len(first) else np.empty(0, bool)
        self.group = np.empty(len(keys), kind)                  # of each probe, its key's place in keys
        self.group[order] = np.repeat(np.arange(len(first), dtype=kind), size)

    def cells(self, sorted_keys: np.ndarray) -> list[tuple[int, int, int]]:
        """``(part, from, to)`` of the non-empty hash ranges."""
        part = (sorted_keys >> np.uint64(self.shift)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, int)
        return [(int(part[a]), int(a), int(b)) for a, b in zip(cut, np.concatenate([cut[1:], [len(part)]]))] if len(part) else []

    def windows(self, bits: list) -> None:
        """The windows whose anchors are all hit; ``bits``: of the anchored keys, by part."""
        hit = np.zeros(len(self.keys), bool)
        answer = dict(bits)
        for part, a, b in self.cells(self.keys):
            at = a + np.flatnonzero(self.anchored[a:b])
            if len(at):
                hit[at] = np.unpackbits(np.frombuffer(answer[part], np.uint8), count=len(at)).astype(bool)
        here = np.zeros(len(self.h) + self.block, bool)         # at anchors: whether they are hit
        here[self.probe] = hit[self.group]
        s = np.flatnonzero(self.left >= self.window)
        next_anchor = s + (-self.place[s]) % self.block
        ok = here[next_anchor] & ((self.place[s] % self.block != 0) | here[s + self.block])
        self.at = s[ok]
        if len(self.at):
            wide = _rolling(self.h, self.window, A)[self.at]
            self.wide, exact = wide, _rolling(self.h, self.window, C)[self.at]
        else:
            self.wide = exact = np.empty(0, np.uint64)
        self.exact, self.first, self.same = np.unique(exact, return_index=True, return_inverse=True)
        self.order = np.lexsort((self.first, self.wide[self.first] >> np.uint64(self.shift)))   # by part, then by place

    def removed(self, bits: list) -> np.ndarray:
        """Which words a window covers whose words also start earlier; ``bits``: of first windows."""
        won = np.zeros(len(self.exact), bool)
        answer = dict(bits)
        for part, a, b in self.cells(self.wide[self.first][self.order]):
            won[self.order[a:b]] = np.unpackbits(np.frombuffer(answer[part], np.uint8), count=b - a).astype(bool)
        later = ~(won[self.same] & (self.first[self.same] == np.arange(len(self.at))))
        edge = np.zeros(len(self.h) + self.window + 1, np.int64)
        np.add.at(edge, self.at[later], 1)
        np.add.at(edge, self.at[later] + self.window, -1)
        return np.cumsum(edge)[:len(self.h)] > 0


def _cells(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.binary())], ["part", "batch", "body"])


def _probes(window, parts):
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for row in each_row(batches, ["batch", "doc_ids", "sizes", "body"]):
            b, rows = Batch(row, window, parts), []
            short = ((b.keys >> np.uint64(b.shift - 32)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            for part, x, y in b.cells(b.keys):
                steps = np.diff(short[x:y], prepend=np.uint32(0)).astype("<u4")       # ascending: small steps
                planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()
                flags = np.packbits(b.anchored[x:y]).tobytes() + np.packbits(b.often[x:y]).tobytes()
                rows.append((part, b.number, np.int64(y - x).tobytes() + pack.compress(planes + flags)))
            if rows:
                yield _cells(rows)
    return run


def _answers(batch, part, bits):
    return pa.table({"batch": pa.array(batch, pa.int64()), "part": pa.array(part, pa.int64()), "bits": pa.array(bits, pa.binary())})


def _hits(table: pa.Table) -> pa.Table:
    """For each batch, one bit for each of its anchored keys in this part: seen anywhere else."""
    unpack = zstandard.ZstdDecompressor()
    keys, anchored, often = [], [], []
    for body in table.column("body").to_pylist():
        n, data = int(np.frombuffer(body[:8], np.int64)[0]), unpack.decompress(body[8:])
        steps = np.ascontiguousarray(np.frombuffer(data[:4 * n], np.uint8).reshape(4, n).T).view("<u4").ravel()
        keys.append(np.cumsum(steps, dtype=np.uint32))
        flags = np.frombuffer(data[4 * n:], np.uint8)
        anchored.append(np.unpackbits(flags[:-(-n // 8)], count=n).astype(bool))
        often.append(np.unpackbits(flags[-(-n // 8):], count=n).astype(bool))
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], every[order][1:] != every[order][:-1]]))
    size = np.diff(np.concatenate([cut, [len(every)]]))
    hit = (size > 1) | np.logical_or.reduceat(np.concatenate(often)[order], cut)
    result = np.empty(len(every), bool)
    result[order] = np.repeat(hit, size)
    parts = np.split(result, np.cumsum([len(k) for k in keys])[:-1])
    bits = [np.packbits(p[a]).tobytes() for p, a in zip(parts, anchored)]
    return _answers(table.column("batch"), table.column("part"), bits)


def _candidates(window, parts):
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for row in each_row(batches, ["batch", "doc_ids", "sizes", "body", "hits"]):
            b, rows = Batch(row, window, parts), []
            b.windows([(x["part"], x["bits"]) for x in row["hits"] or []])
            ids = np.array([NULL_ID if i is None else i for i in b.ids], np.int64)
            for part, x, y in b.cells(b.wide[b.first][b.order]):
                mine = b.order[x:y]
                doc, runs = np.unique(b.doc[b.at[b.first[mine]]], return_counts=True)
                body = b"".join([b.exact[mine].tobytes(), ids[doc].tobytes(), runs.astype(np.int64).tobytes()])
                rows.append((part, b.number, np.array([y - x, len(doc)], np.int64).tobytes() + pack.compress(body)))
            if rows:
                yield _cells(rows)
    return run


def _firsts(table: pa.Table) -> pa.Table:
    """For each batch, one bit for each of its distinct windows in this part: first of all batches."""
    unpack = zstandard.ZstdDecompressor()
    keys, docs, owners = [], [], []
    numbers = table.column("batch").to_numpy()
    for body, number in zip(table.column("body").to_pylist(), numbers):
        n, m = np.frombuffer(body[:16], np.int64).tolist()
        data = unpack.decompress(body[16:])
        keys.append(np.frombuffer(data[:8 * n], np.uint64))
        ids, runs = np.frombuffer(data[8 * n:], np.int64).reshape(2, m)
        docs.append(np.repeat(ids, runs))
        owners.append(np.full(n, number))
    every = np.concatenate(keys)
    order = np.lexsort((np.concatenate(owners), np.concatenate(docs), every))
    first = np.zeros(len(every), bool)
    first[order[np.concatenate([[True], every[order][1:] != every[order][:-1]])]] = True
    bits = [np.packbits(p).tobytes() for p in np.split(first, np.cumsum([len(k) for k in keys])[:-1])]
    return _answers(table.column("batch"), table.column("part"), bits)


def _kept(window, parts):
    def run(batches):
        for row in each_row(batches, ["batch", "doc_ids", "sizes", "body", "hits", "firsts"]):
            b = Batch(row, window, parts, keep_words=True)
            b.windows([(x["part"], x["bits"]) for x in row["hits"] or []])
            gone = b.removed([(x["part"], x["bits"]) for x in row["firsts"] or []])
            n_removed = np.add.reduceat(np.concatenate([gone, [False]]).astype(np.int64), np.minimum(b.start[:-1], len(gone)))
            n_removed[b.n == 0] = 0
            texts = [b" ".join(w) if not g else b" ".join([x for x, d in zip(w, gone[s:s + len(w)].tolist()) if not d])
                     for w, g, s in zip(b.words, n_removed.tolist(), b.start.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.ids, pa.int64()), pa.array(b.n), pa.array(n_removed), pa.array([t.decode() for t in texts], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row: without the words that a window of
    ``window`` (even) words covers whose word sequence also starts earlier.

    Earlier is a smaller id, or the same document and an earlier start; rows that repeat an id
    come in the order in which they are read, and null ids after all others.  Words are what ASCII
    white space separates; null and empty texts have none, and texts of fewer than ``window`` words
    lose none.  Extra columns are left out.  ``docs`` is read more than once: it must be a scan of
    files, or checkpointed, so that a repeated read gives the same partitions."""
    spark = docs.sparkSession
    prepare(spark)
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    text = narrow_input(docs, id_col, text_col)
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = LEAST_PARTS
    while parts * part_bytes < size:
        parts *= 2
    batches = text.mapInArrow(text_batches(batch_bytes), TEXTS)

    def by_batch(bits, name):
        return bits.groupBy("batch").agg(F.collect_list(F.struct("part", "bits")).alias(name))

    probes = text.mapInArrow(chained(text_batches(batch_bytes), _probes(window, parts)), CELL)
    hits = by_batch(probes.groupBy("part").applyInArrow(_hits, BITS), "hits")
    hit = batches.join(hits, "batch", "left")
    firsts = by_batch(hit.mapInArrow(_candidates(window, parts), CELL).groupBy("part").applyInArrow(_firsts, BITS), "firsts")
    return hit.join(firsts, "batch", "left").mapInArrow(
        _kept(window, parts), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
