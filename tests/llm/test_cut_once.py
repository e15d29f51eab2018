"""Texts are cut or encoded once in op2's and op6's tasks, whatever spaces they hold."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex

from ticketloom.llm import bpe as B
from ticketloom.llm import packing as P
from ticketloom.llm.common import gathered, text_batches

TEXTS = ["", " ", "  a", "a  ", "a \n\n b", "　x y", "don't  stop. a, b.", "é́ ", "x" * 300, " " * 500 + "a",
         "\U0001F600 hi\t\tthere \r\n", "12345 67", "a\x85b \x1c c", ".", ", . ,", "one two two, one", "one two two, one"]


def test_words_give_texts_back(monkeypatch):
    calls, cut = [], B.units
    monkeypatch.setattr(B, "units", lambda text: calls.append(text) or cut(text))
    pattern = regex.compile(public_tokenizers.PATTERN)
    words = B.Words(TEXTS, pattern, lines=True)
    assert words.words == B.Words(TEXTS, pattern).words == sorted({w for t in TEXTS for w in pattern.findall(t)})
    calls.clear()
    words = B.Words(TEXTS, pattern, lines=True)
    counted = [b"%d;" % k for k in range(len(words.words))]
    got = list(words.texts_of([w.encode() for w in words.words], counted))
    assert [plain for plain, _ in got] == [t.encode() for t in TEXTS] and calls == TEXTS
    place = {w: c for w, c in zip(words.words, counted)}
    assert [ids for _, ids in got] == [b"".join(place[w] for w in pattern.findall(t)) for t in TEXTS]


def test_packing_encodes_whole_texts(monkeypatch):
    ranks = P.read_vocabulary(public_tokenizers.path(P.VOCABULARY))
    encoder, calls = P._encoder(ranks, public_tokenizers.PATTERN), []

    class Counted:
        @staticmethod
        def encode_ordinary(text):
            calls.append(text)
            return encoder.encode_ordinary(text)

    class Shared:
        value = (ranks, public_tokenizers.PATTERN)

    monkeypatch.setattr(P, "_encoder", lambda *_: Counted)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["doc_id", "text"])
    out, = P._tokens(Shared, P.END_ID)([batch])
    assert calls == TEXTS
    assert [x.tolist() for x in P._ids(out)] == [[*encoder.encode_ordinary(t), P.END_ID] for t in TEXTS]
    assert np.frombuffer(out.column("ids")[0].as_py(), "<u2").tolist() == [P.END_ID]


def test_texts_are_put_together_as_arrow_values(monkeypatch):
    pattern = regex.compile(public_tokenizers.PATTERN)
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["doc_id", "text"])
    # where words are sent, texts are gathered as they come, in the same batches, without packing them
    packed = [r for b in text_batches(400)([rows]) for r in b.to_pylist()]
    assert [r["batch"] for r in packed] == [number for number, _, _ in gathered([rows], 400)] and len(packed) > 1
    sent = [(r["batch"], r["part"], B._unpack(r["body"], 2)) for b in B._send(public_tokenizers.PATTERN, 4, 400)([rows]) for r in b.to_pylist()]
    answers = {}
    for batch, part, (sizes, data) in sent:
        words = B._slices(data, np.frombuffer(sizes, np.uint32))
        ids = [np.array([part, len(w)], "<u4").tobytes() for w in words]
        answers.setdefault(batch, []).append({"part": part, "body": B._pack(
            np.full(len(words), 2, np.uint32).tobytes(), b"".join(ids), sizes, data)})
    # where ids return, no text is put together in Python
    monkeypatch.setattr(B.Words, "texts_of", None)
    monkeypatch.setattr(B, "OUT_BYTES", 300)
    table = pa.table({"doc_ids": [r["doc_ids"] for r in packed], "sizes": [r["sizes"] for r in packed],
                      "body": pa.array([r["body"] for r in packed], pa.binary()),
                      "found": [answers.get(r["batch"]) for r in packed]})
    out = list(B._assemble(public_tokenizers.PATTERN, 4)(table.to_batches()))
    assert len(out) > len(packed)
    part_of = {w: part for _, part, (sizes, data) in sent for w in B._slices(data, np.frombuffer(sizes, np.uint32))}
    got = [r for b in out for r in b.to_pylist()]
    assert [(r["doc_id"], r["decoded"]) for r in got] == [(k, t.encode()) for k, t in enumerate(TEXTS)]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in got] == [
        [x for w in pattern.findall(t) for x in (part_of[w.encode()], len(w.encode()))] for t in TEXTS]
