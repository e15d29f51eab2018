"""op2's Python steps handle words as Arrow arrays, not one by one as Python objects."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex

from ticketloom.llm import bpe as B

PIECES = ["a", "Été", "日本", "x.", "y,", "é.", "don't", "12", ".", ",", "-", "\n", "\t", "\x1c", "\x85", "　", " ", "  ", "\0", "\U0001F600"]


def test_units_keep_the_texts_bytes():
    assert B.units("one two. é\n 　x  y ").to_pylist() == ["one", " two.", " é\n 　x ", " y "]
    pick = random.Random(2)
    for _ in range(300):
        text = " ".join(pick.choice(PIECES) for _ in range(pick.randrange(8)))
        parts = B.units(text).to_pylist()
        assert parts == re.split(r"(?= \S)", text) if not re.match(r" \S", text) else parts == ["", *re.split(r"(?= \S)", text)[1:]]


def test_plain_words_do_not_become_python_strings(monkeypatch):
    seen, objects = [], B._objects
    monkeypatch.setattr(B, "_objects", lambda values: seen.append(objects(values)) or seen[-1])
    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = ["first plain words, and others. plain 12 été", "first Words. été, don't"] * 50
    words = B.Words(texts, pattern, lines=True)
    assert len(seen) == 1 and sorted(seen[0]) == [" 12", " don't", " été", " été,"]     # only these need Python
    assert [t for t, in words.texts_of([w.encode() for w in words.words])] == [t.encode() for t in texts]


def test_words_of_random_texts():
    pattern, pick = regex.compile(public_tokenizers.PATTERN), random.Random(3)
    texts = ["".join(pick.choice(PIECES) + pick.choice(["", " "]) for _ in range(pick.randrange(30))) for _ in range(300)]
    words = B.Words(texts, pattern, lines=True)
    assert words.words == sorted({w for t in texts for w in pattern.findall(t)})
    assert [t for t, in words.texts_of([b"%s|" % w.encode() for w in words.words])] == [
        "".join(w + "|" for w in pattern.findall(t)).encode() for t in texts]
    parts = words.by_part(4)
    assert [own.to_pylist() for _, own, _ in parts] == [[words.words[k].encode() for k in at] for _, _, at in parts]
    assert sorted(k for _, _, at in parts for k in at.tolist()) == list(range(len(words.words)))
    assert B.Words([], pattern, lines=True).words == B.Words([""], pattern).words == [] == B.Words([""], pattern).by_part(4)


@pytest.mark.parametrize("limit", [1, 8_000_000])
def test_batches_get_back_the_ids_of_their_words(monkeypatch, limit):
    monkeypatch.setattr(B, "BATCH_BYTES", limit)
    sent = {7: [b"a", b"bb"], 8: [b"bb", b"\xc3\xa9", b"x" * 300], 9: [b"a"]}
    table = pa.table({"part": pa.array([3] * 3, pa.int64()), "batch": pa.array(list(sent), pa.int64()),
                      "body": [B._pack(np.array(list(map(len, own)), np.uint32).tobytes(), b"".join(own)) for own in sent.values()]})
    found = B._distinct(table)
    known = [np.array(w, np.int8).tobytes() for w in found.column("words")[0].as_py()]
    assert known == [b"a", b"bb", b"\xc3\xa9", b"x" * 300]
    encoded = [{"ids": [len(w)] * (k + 1), "plain": w} for k, w in enumerate(known)]
    kind = pa.list_(pa.struct([("ids", pa.list_(pa.int32())), ("plain", pa.binary())]))
    rows = pa.RecordBatch.from_arrays([pa.array([3]), found.column("batches").combine_chunks(), found.column("places").combine_chunks(),
                                       pa.array([encoded], kind)], ["part", "batches", "places", "encoded"])
    back, = B._return([rows])
    assert back.column("batch").to_pylist() == list(sent) and back.column("part").to_pylist() == [3] * 3
    for body, own in zip(back.column("body").to_pylist(), sent.values()):
        n_ids, ids, n_plain, plain = B._unpack(body, 4)
        at = [known.index(w) for w in own]
        assert np.frombuffer(n_ids, np.uint32).tolist() == [k + 1 for k in at] and plain == b"".join(own)
        assert np.frombuffer(ids, "<u4").tolist() == [len(known[k]) for k in at for _ in range(k + 1)]
        assert np.frombuffer(n_plain, np.uint32).tolist() == list(map(len, own))
