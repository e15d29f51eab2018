"""Byte-level BPE encoding and decoding.

Python only cuts texts into the pattern's matches ("words") and gathers the distinct ones.  Spark's
higher-order functions encode each distinct word: a fold over its byte array merges the adjacent
pair of lowest rank, leftmost first, until no pair has a rank.  Ranks come from a literal map of
token pairs, laid out as two cuckoo-hashed arrays so that a lookup is two array accesses.  Decoding
concatenates the binary pieces of the ids.

Texts stay in batches.  A batch sends its distinct words to ``parts`` ranges of the hash space,
where the words of all batches are encoded once, and gets their ids back; a word in every text is
one word per batch.  The number of ranges follows the input, so a range's size doesn't.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import TEXTS, batch_texts, documents, each_row, gathered, narrow_input, prepare, text_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BATCH_BYTES, OUT_BYTES = 8_000_000, 4_000_000
PART_BYTES, LEAST_PARTS = 8_000_000, 64        # of text for each hash range
NONE = (1 << 31) - 1                    # no such pair
BITS = 20                               # of an id in the fold's state
MASK, END, REST = (1 << BITS) - 1, NONE << BITS, 1 << 30

INNER_SPACE = re.compile(r" \s| \Z")
CUT = re.compile(r" (?=\S)")
SPACE, NO_WORDS = ord(" "), pa.array([], pa.string())


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def units(text: str) -> pa.StringArray:
    """The text cut before each space that a visible character follows, its bytes where they were.
    No match of the pattern spans such a cut, so the parts can be encoded alone."""
    data = text.encode()
    if INNER_SPACE.search(text):
        at = np.cumsum([len(part.encode()) + 1 for part in CUT.split(text)[:-1]]) - 1
    else:
        at = np.flatnonzero(np.frombuffer(data, np.uint8) == SPACE)
    stops = np.concatenate([[0], at, [len(data)]]).astype(np.int32)
    return pa.StringArray.from_buffers(len(stops) - 1, pa.py_buffer(stops), pa.py_buffer(data))


def pairs(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The pair of tokens whose merge makes each token: the last two pieces when its bytes are
    merged by the ranks below its own.  Every merge that encoding makes is one of these."""
    out = {}
    for token, rank in ranks.items():
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best = min((ranks.get(a + b, rank), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] >= rank:
                raise ValueError(f"token {rank} cannot be made by merges of lower rank")
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        if len(parts) == 2:
            out[ranks[parts[0]], ranks[parts[1]]] = rank
    return out


def cuckoo(entries: dict[int, int]) -> tuple:
    """Two ``(keys, values)`` tables of prime length: a key lies at ``key mod length`` in one of them."""
    size = max(16, int(len(entries) * 1.4))
    while True:
        sizes = []
        while len(sizes) < 2:
            size += 1
            if all(size % d for d in range(2, int(size ** 0.5) + 1)):
                sizes.append(size)
        tables = [dict(), dict()]
        ok = True
        for key, value in entries.items():
            item, side = (key, value), 0
            for _ in range(500):
                place = item[0] % sizes[side]
                item, tables[side][place] = tables[side].get(place), item
                if item is None:
                    break
                side = 1 - side
            else:
                ok = False
                break
        if ok:
            return tuple(([t[p][0] if p in t else -1 for p in range(n)], [t[p][1] if p in t else 0 for p in range(n)])
                         for n, t in zip(sizes, tables))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _lookup(t, a: Column, b: Column) -> Column:
    """Rank (and id) of the merged pair, or ``NONE``.  Repeated sub-expressions are cheaper here
    than binding them."""
    key = a.cast("bigint") * 65_537 + b
    return (F.when(F.get(t["k1"], key % t["n1"]) == key, F.get(t["v1"], key % t["n1"]))
            .when(F.get(t["k2"], key % t["n2"]) == key, F.get(t["v2"], key % t["n2"])).otherwise(F.lit(NONE)))


def _entry(rank: Column, token: Column) -> Column:
    """One token of the fold's state: the rank of its merge with the next one, and its id."""
    return F.shiftleft(rank.cast("bigint"), BITS) + token


def _merge(t, state):
    """One step of the fold: the leftmost pair of the lowest rank becomes one token.  (Entries of
    equal rank are equal, so the smallest entry's first place is that pair.)"""
    def at(low, k):
        new = F.shiftright(low, BITS)
        here = _entry(_lookup(t, new, F.get(state, k + 1).bitwiseAND(F.lit(MASK).cast("bigint"))), new)
        rest = F.slice(state, k + 2, F.lit(REST))
        before = F.get(state, k - 2).bitwiseAND(F.lit(MASK).cast("bigint"))
        return (F.when(k == 1, F.concat(F.array(here), rest))
                .otherwise(F.concat(F.slice(state, 1, k - 2), F.array(_entry(_lookup(t, before, new), before), here), rest)))
    return _let(F.array_min(state), lambda low: F.when(low >= END, state).otherwise(
        _let(F.array_position(state, low).cast("int"), lambda k: at(low, k))))


def encode_word(t, word: Column) -> Column:
    """Ids of one word, an ``array<tinyint>`` of its bytes; ``t`` holds the literal tables."""
    after = F.concat(F.slice(word, 2, F.lit(REST)), F.array(F.lit(None).cast("tinyint")))
    start = F.zip_with(word, after, lambda a, b: _entry(
        F.coalesce(F.get(t["first"], a.cast("int") * 256 + b + 32_896), F.lit(NONE)), F.get(t["byte"], a.cast("int") + 128)))
    merged = F.aggregate(F.slice(word, 2, F.lit(REST)), start, lambda s, _: _merge(t, s))   # as many steps as merges can be
    return F.transform(merged, lambda e: e.bitwiseAND(F.lit(MASK).cast("bigint")).cast("int"))


def decode_ids(t, ids: Column) -> Column:
    """The concatenated bytes of the ids."""
    return F.aggregate(ids, F.lit(b""), lambda out, i: F.concat(out, F.get(t["token"], i)))


def tables(ranks: dict[bytes, int]) -> Column:
    """The literal rank map, byte ids and token bytes as one struct column."""
    merged = pairs(ranks)
    (k1, v1), (k2, v2) = cuckoo({a * 65_537 + b: c for (a, b), c in merged.items()})
    signed = [ranks[bytes([b & 255])] for b in range(-128, 128)]
    first = [merged.get((a, b), NONE) for a in signed for b in signed]
    names = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        names[rank] = token

    def numbers(values, kind):
        return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")
    return F.struct(numbers(k1, "bigint").alias("k1"), numbers(v1, "int").alias("v1"), F.lit(len(k1)).cast("bigint").alias("n1"),
                    numbers(k2, "bigint").alias("k2"), numbers(v2, "int").alias("v2"), F.lit(len(k2)).cast("bigint").alias("n2"),
                    numbers(signed, "int").alias("byte"), numbers(first, "int").alias("first"),
                    F.transform(F.split(F.lit(",".join(n.hex() for n in names)), ","), F.unhex).alias("token"))



class Words:
    """The distinct words of some texts, sorted, and how the texts are made of them.

    Units that begin with a space are numbered: words alone first, then words with a full stop or comma, then
    others; ``lines``, if asked for, holds the numbers of all texts' units, with each text's first one
    (``begins``) numbered after the others."""

    def __init__(self, texts: list[str], pattern, lines: bool = False):
        cut = [units(text) for text in texts]
        begins = [c[0].as_py() for c in cut]
        self.lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        rest = pa.concat_arrays([NO_WORDS, *(c[1:] for c in cut)])
        del cut
        rest = rest.dictionary_encode() if lines else rest.unique()
        distinct = rest.dictionary if lines else rest
        # letters alone, or before one full stop or comma, are plain matches of the pattern
        kind = np.full(len(distinct), 2, np.uint8)
        kind[np.asarray(pc.match_substring_regex(distinct, r"^ [A-Za-z]+[.,]\z"))] = 1
        kind[np.asarray(pc.match_substring_regex(distinct, r"^ [A-Za-z]+\z"))] = 0
        ended = distinct.filter(pa.array(kind == 1))
        other = [self._matches(unit, pattern) for unit in _objects(distinct.filter(pa.array(kind == 2)))]
        first = {u: pattern.findall(u) for u in dict.fromkeys(begins)}
        several = [*other, *first.values()]
        del other
        found = pa.concat_arrays([
            distinct.filter(pa.array(kind == 0)), pc.utf8_slice_codeunits(ended, 0, -1),
            pc.utf8_slice_codeunits(ended, -1), pa.array(chain.from_iterable(several), pa.string())]).dictionary_encode()
        order = np.asarray(pc.array_sort_indices(found.dictionary))
        self.distinct = found.dictionary.take(pa.array(order))
        if not lines:
            return
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        place = place[np.asarray(found.indices)]
        n, e = int(np.count_nonzero(kind == 0)), len(ended)
        self.flat = np.concatenate([place[:n], np.stack([place[n:n + e], place[n + e:n + 2 * e]], 1).ravel(), place[n + 2 * e:]])
        self.size = np.concatenate([np.ones(n, np.int64), np.full(e, 2), np.fromiter(map(len, several), np.int64, len(several))])
        numbers = np.empty(len(kind), np.int32)
        numbers[np.argsort(kind, kind="stable")] = np.arange(len(kind), dtype=np.int32)
        begin_numbers = dict(zip(first, count(len(kind))))
        inner = np.ones(int(self.lengths.sum()), bool)
        starts = np.cumsum(self.lengths) - self.lengths
        inner[starts] = False
        self.lines = np.empty(len(inner), np.int32)
        self.lines[inner] = numbers[np.asarray(rest.indices)]
        self.lines[starts] = [begin_numbers[begin] for begin in begins]

    @staticmethod
    def _matches(unit: str, pattern) -> list[str]:
        if unit[1:].isalpha():
            return [unit]
        if unit[-1] in ".," and unit[1:-1].isalpha():
            return [unit[:-1], unit[-1]]
        return pattern.findall(unit)

    @property
    def words(self) -> list[str]:
        return _objects(self.distinct)

    def by_part(self, parts: int) -> list[tuple[int, pa.BinaryArray, np.ndarray]]:
        """Each part of the hash space that has words: its number, they, and their places."""
        spelled = self.distinct.cast(pa.binary())
        part = (np.fromiter(map(xxhash.xxh3_64_intdigest, _objects(spelled)), np.uint64, len(spelled)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        spelled = spelled.take(pa.array(order))
        cuts = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)] if len(order) else []
        return [(int(part[order[a]]), spelled[a:b], order[a:b]) for a, b in zip(cuts, cuts[1:])]

    def joined(self, *columns: pa.BinaryArray) -> list[pa.BinaryArray]:
        """The texts with their words replaced by each column's values; ``take`` gathers them, first by unit, then by text."""
        flat, lines = pa.array(self.flat), pa.array(self.lines)
        return [_runs(_runs(of.take(flat), self.size).take(lines), self.lengths) for of in columns]

    def texts_of(self, *columns: list[bytes]) -> Iterator[tuple[bytes, ...]]:
        """Each text with its words replaced by their values, once for each column of values."""
        return zip(*(texts.to_pylist() for texts in self.joined(*(pa.array(of, pa.binary()) for of in columns))))


def _objects(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


def _sizes(values: pa.BinaryArray) -> np.ndarray:
    return np.asarray(pc.binary_length(values)).astype(np.uint32)


def _data(values: pa.BinaryArray) -> bytes:
    """The values' bytes, one after the other."""
    if not len(values):
        return b""
    stops = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset)
    return values.buffers()[2][int(stops[0]):int(stops[-1])].to_pybytes() if stops[-1] > stops[0] else b""


def _binaries(sizes: np.ndarray, data: bytes) -> pa.BinaryArray:
    """Values of these sizes, which lie one after the other."""
    stops = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    if stops[-1] >= 1 << 31:
        raise ValueError("over 2 GB of values in a batch")
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(data)])


def _runs(values: pa.Array, sizes: np.ndarray) -> pa.BinaryArray:
    """Each run of so many values as one value; no byte moves."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    stops = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset)
    first = np.concatenate([[0], np.cumsum(sizes)])
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(stops[first]), values.buffers()[2]])


def _pack(*arrays) -> bytes:
    """Some byte strings as one compressed string."""
    sizes = np.array([len(a) for a in arrays], np.int64)
    return sizes.tobytes() + zstandard.ZstdCompressor(level=1).compress(b"".join(arrays))


def _unpack(body: bytes, n: int) -> list[bytes]:
    sizes = np.frombuffer(body[:8 * n], np.int64)
    return _slices(zstandard.ZstdDecompressor().decompress(body[8 * n:]) if sizes.sum() else b"", sizes)


def _slices(data: bytes, sizes: np.ndarray) -> list[bytes]:
    stops = np.cumsum(sizes, dtype=np.int64).tolist()
    return [data[b - s:b] for s, b in zip(sizes.tolist(), stops)]


def _send(pattern_text, parts, batch_bytes):
    def run(batches):
        pattern = regex.compile(pattern_text)
        for number, _, texts in gathered(batches, batch_bytes):
            words = Words([t.decode() for t in texts], pattern)
            del texts
            cells = [(part, _pack(_sizes(own).tobytes(), _data(own))) for part, own, _ in words.by_part(parts)]
            if cells:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[0] for c in cells], pa.int64()), pa.array([number] * len(cells), pa.int64()),
                     pa.array([c[1] for c in cells], pa.binary())], ["part", "batch", "body"])
            del words, cells
            pa.default_memory_pool().release_unused()           # what a batch took is given back
    return run


PART = "part bigint, batches array<bigint>, places array<binary>, words array<array<tinyint>>"


def _distinct(table: pa.Table) -> pa.Table:
    """One row: the part's distinct words, and for each batch the places of its words among them."""
    known, places, held, size = {}, [], [], 0
    bodies = table.column("body")
    for k in range(len(bodies)):
        sizes, data = _unpack(bodies[k].as_py(), 2)
        held.append(_binaries(np.frombuffer(sizes, np.uint32), data))
        size += len(sizes) + len(data)
        if k + 1 == len(bodies) or size > BATCH_BYTES:              # few at a time: words may be long
            found = pa.concat_arrays(held).dictionary_encode()
            number = np.array([known.setdefault(w, len(known)) for w in _objects(found.dictionary)], np.uint32)
            number = number[np.asarray(found.indices)]
            stops = np.cumsum([0, *map(len, held)]).tolist()
            places += [number[a:b].tobytes() for a, b in zip(stops, stops[1:])]
            held, size = [], 0
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in known])]).astype(np.int32)
    words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(known), np.int8)))
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64()),
                     "batches": pa.array([table.column("batch").to_pylist()], pa.list_(pa.int64())),
                     "places": pa.array([places], pa.list_(pa.binary())),
                     "words": pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), words)})


def _return(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            found = batch.column("encoded")[k].values
            ids, plain = found.field("ids"), found.field("plain")
            ids = _binaries(np.asarray(ids.value_lengths()) * 4, np.asarray(ids.flatten()).astype("<u4").tobytes())
            rows = [[], []]
            for number, places in zip(batch.column("batches")[k].as_py(), batch.column("places")[k].as_py()):
                places = pa.array(np.frombuffer(places, np.uint32))
                own_ids, own_plain = ids.take(places), plain.take(places)
                rows[0].append(number)
                rows[1].append(_pack((_sizes(own_ids) // 4).tobytes(), _data(own_ids), _sizes(own_plain).tobytes(), _data(own_plain)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array([batch.column("part")[k].as_py()] * len(rows[0]), pa.int64()),
                 pa.array(rows[1], pa.binary())], ["batch", "part", "body"])


def _assemble(pattern_text, parts):
    def run(batches):
        pattern = regex.compile(pattern_text)
        for row in each_row(batches, ["doc_ids", "sizes", "body", "found"]):
            words = Words([t.decode() for t in batch_texts(row)], pattern, lines=True)
            del row["body"]
            answers = {x["part"]: x["body"] for x in row.pop("found") or []}
            cells = [(places, *_unpack(answers.pop(part), 4)) for part, _, places in words.by_part(parts)]
            place = np.empty(len(words.distinct), np.int32)                # of each word among the answers
            place[np.concatenate([c[0] for c in cells] or [np.zeros(0, np.int64)])] = np.arange(len(place))
            place = pa.array(place)
            known = [_binaries(np.frombuffer(b"".join(c[n] for c in cells), np.uint32) * np.uint32(width),
                               b"".join(c[n + 1] for c in cells)).take(place) for n, width in ((1, 4), (3, 1))]
            del answers, cells
            encoded, decoded = words.joined(*known)
            del words, known
            ids = pa.array(row["doc_ids"], pa.int64())
            size = np.cumsum(np.asarray(pc.add(pc.binary_length(encoded), pc.binary_length(decoded))), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(size // OUT_BYTES)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_arrays([x.slice(a, b - a) for x in (ids, encoded, decoded)], ["doc_id", "ids", "decoded"])
            del ids, encoded, decoded
    return run


def bpe_round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id",
                   text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, ids, decoded`` of every row: the ids as little-endian unsigned 32-bit integers,
    and the bytes that they decode to.

    Null text is empty text, with no ids.  Repeated rows and ids are rows like others; extra
    columns are left out.  ``ranks`` (at most 2**20 tokens, all single bytes among them) must be
    such that every token is made by merges of lower rank, as BPE training gives; else it raises.
    ``docs`` is read more than once: it must be a scan of files, or checkpointed, so that a repeated
    read gives the same partitions."""
    spark = docs.sparkSession
    prepare(spark)
    if max(ranks.values()) > MASK:
        raise ValueError("ids over 20 bits")
    text = narrow_input(docs, id_col, text_col)
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = LEAST_PARTS
    while parts * PART_BYTES < size:
        parts *= 2
    batches = text.mapInArrow(text_batches(batch_bytes), TEXTS)
    words = (text.mapInArrow(_send(pattern, parts, batch_bytes), "part bigint, batch bigint, body binary")
             .groupBy("part").applyInArrow(_distinct, PART))
    known = F.struct(tables(ranks).alias("t"), F.col("words").alias("words"))
    encoded = _let(known, lambda v: F.transform(v["words"], lambda w: _let(encode_word(v["t"], w), lambda ids: F.struct(
        ids.alias("ids"), decode_ids(v["t"], ids).alias("plain")))))
    found = words.select("part", "batches", "places", encoded.alias("encoded")).mapInArrow(
        _return, "batch bigint, part bigint, body binary").groupBy("batch").agg(F.collect_list(F.struct("part", "body")).alias("found"))
    return batches.join(found, "batch", "left").mapInArrow(_assemble(pattern, parts), "doc_id bigint, ids binary, decoded binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe_round_trip(documents(spark, sf_dir), read_ranks(public_tokenizers.path(VOCABULARY)))
    return done.select("doc_id", F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
