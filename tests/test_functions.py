"""Hand-written cases for the exact string/JSON semantics,
each compared with Python's own json / re / str."""

import json
import re
import unicodedata

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF01
from ticketloom.functions import jsonx
from ticketloom.functions.text import ascii_words, json_block, py_strip, reply_tail, tokens
from ticketloom.operators.records import _count_tokens

JSON_CASES = [None, "", "{}", "[1,2]", "null", '""', "{'a':1}", '{"a":1} x', '{"a":1,}', '{"a":1}]',
              '{"a":1}] [{"b":2}', '{"a":1}} {"b":{"c":2}', '{"a":1},"q":{"b":2}', '{"a":1}{"b":2}',
              '{"a":1,"a":2}', '{"a":NaN}', '{"a":{"b":[1,2]}}', '{"a":01}', '{"a":"x\u0001y"}',
              '{"a":"\\q"}', ' {"a": 1} ', '{"a":null,"b":"s","c":5}', '{"a":Infinity}', "{\n}\n",
              '{"a":1,"b":2,"a":3}']


def _py_obj(s):
    try:
        v = json.loads(s)
    except Exception:
        return None
    return v if isinstance(v, dict) else None


def test_json_object_acceptance_and_last_value(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(JSON_CASES)], "i int, s string")
    out = jsonx.with_object(df, F.col("s"), "m")
    rows = out.select("i", F.col("m").isNotNull().alias("ok"),
                      F.map_keys("m").alias("keys"),
                      jsonx.as_text(jsonx.value("m", "a")).alias("a")).orderBy("i").collect()
    for r in rows:
        expected = _py_obj(JSON_CASES[r.i]) if JSON_CASES[r.i] is not None else None
        assert r.ok == (expected is not None), JSON_CASES[r.i]
        if expected is not None:
            assert r["keys"] == list(expected.keys())
            if "a" in expected and isinstance(expected["a"], (int, str)):
                assert r.a == str(expected["a"])


def test_key_presence_null_and_type(spark):
    df = spark.createDataFrame([('{"a": null, "b": "s", "c": 5}',)], "s string")
    m = jsonx.with_object(df, F.col("s"), "m")
    r = m.select(jsonx.has_key("m", "a").alias("ha"), jsonx.has_key("m", "z").alias("hz"),
                 jsonx.get_or("m", "a", "dflt").alias("ga"), jsonx.get_or("m", "z", "dflt").alias("gz"),
                 jsonx.as_string(jsonx.value("m", "c")).alias("sc"),
                 jsonx.json_text(jsonx.value("m", "c")).alias("jc"),
                 jsonx.json_text(jsonx.value("m", "b")).alias("jb")).first()
    assert r.ha is True and r.hz is False
    assert r.ga is None and r.gz == "dflt"          # JSON null stays null; default only on absence
    assert r.sc is None                               # a number is not a string
    assert r.jc == "5" and r.jb == '"s"'              # 5 != "5"


def test_strip_matches_python(spark):
    ends = ["\t", "\n", " ", "\u0085", " ", "\u001c", " "]
    cases = [e + "x y" + e for e in ends] + ["​x​", "  ", ""]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in df.select(py_strip("s")).collect()]
    assert got == [c.strip() for c in cases]


def test_words_match_python_regex(spark):
    s = "éabc abc1 _x foo café hi"
    s = s.replace("café", "caf́e")
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(ascii_words("s")).first()[0] == ["foo", "caf", "e", "hi"]
    assert re.findall(r"\b[a-z]+\b", s.lower()) == ["foo", "caf", "e", "hi"]


def test_words_on_documents_match_python(spark):
    texts = pq.read_table(f"{SF01}/documents.parquet", columns=["doc_id", "text"]).to_pylist()[:300]
    df = spark.createDataFrame([(t["doc_id"], t["text"]) for t in texts], "doc_id long, text string")
    got = {r[0]: r[1] for r in df.select("doc_id", ascii_words("text")).collect()}
    for t in texts:
        assert got[t["doc_id"]] == re.findall(r"\b[a-z]+\b", t["text"].lower())


def test_reply_tail_and_json_block(spark):
    cases = ["a [/INST] b [/INST]  {x} tail } end ", "no marker {a\n}", "nothing here"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    rows = df.select(reply_tail("s").alias("t")).select("t", json_block("t").alias("b")).collect()
    for c, r in zip(cases, rows):
        tail = c.split("[/INST]")[-1].strip()
        m = re.search(r"\{.*\}", tail, re.DOTALL)
        assert r.t == tail
        assert r.b == (m.group() if m else None)


def test_token_count_of_constant_parts(spark):
    s = "<s>[INST] <<SYS>>\nYou are: 1. ok_goé  x\n<</SYS>>\n\n"
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(F.size(tokens("s"))).first()[0] == _count_tokens(s)
    assert unicodedata.category(" ") == "Zs"


def _fuzz_cases(n, seed=7):
    """Random JSON objects (nested values, escapes, numbers, whitespace,
    repeated keys at every level), some of them corrupted."""
    import random
    rnd = random.Random(seed)

    def rstr():
        parts = ['a', 'Z', ' ', '\\n', '\\"', '\\\\', '\\u00e9', 'é', '/', '\\/', '\\t', '1']
        return '"' + "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 5))) + '"'

    def rval(depth):
        k = rnd.random()
        if depth > 2 or k < 0.4:
            return rstr()
        if k < 0.6:
            return rnd.choice(["0", "-1", "3.5", "1e3", "2E-2", "123456789012", "-0"])
        if k < 0.7:
            return rnd.choice(["true", "false", "null"])
        if k < 0.85:
            return "[" + ", ".join(rval(depth + 1) for _ in range(rnd.randint(0, 3))) + "]"
        return robj(depth + 1)

    def robj(depth=0):
        keys = [rnd.choice(["a", "b", "Ticket Type", "é"]) for _ in range(rnd.randint(0, 4))]
        ws = lambda: rnd.choice(["", " ", "\n", "\t"])
        return "{" + ws() + ("," + ws()).join(f'"{k}"{ws()}:{ws()}{rval(depth)}' for k in keys) + ws() + "}"

    def corrupt(s):
        k = rnd.random()
        if not s or k < 0.35:
            return s
        i = rnd.randrange(len(s))
        if k < 0.55:
            return s[:i] + s[i + 1:]
        if k < 0.75:
            return s[:i] + rnd.choice(list('{}[],:"\' x\\')) + s[i:]
        if k < 0.85:
            return s[:i]
        return s + rnd.choice([" x", "}", "]", ",", " {}", "\n"])

    return [corrupt(robj()) for _ in range(n)]


def test_json_fuzz_matches_python(spark):
    cases = _fuzz_cases(400)
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string")
    out = jsonx.with_object(df, F.col("s"), "m")
    rows = out.select("i", F.col("m").isNotNull().alias("ok"), F.map_keys("m").alias("keys"),
                      F.transform(F.map_values("m"), lambda v: F.to_json(v)).alias("vals")).collect()
    for r in rows:
        exp = _py_obj(cases[r.i])
        assert r.ok == (exp is not None), cases[r.i]
        if exp is not None:
            assert r["keys"] == list(exp.keys())
            assert [json.loads(v) for v in r.vals] == list(exp.values())


def test_text_fuzz_matches_python(spark):
    """strip, \\b[a-z]+\\b words, reply tail and the {...} block against
    Python on random strings of mixed scripts, combining marks, odd spaces,
    final sigma and dotted capital I."""
    import random
    rnd = random.Random(11)
    pool = list("abcxyz ABC_019") + ["é", "ß", "İ", "Σ", "ς", "́", "​", " ", " ", "\u0085",
                                      "\u001c", "\t", "\n", "\x0b", "-", "'", "中", "٣", "²", "😀",
                                      "ǅ", "ﬁ", "K", "[/INST]", "{", "}", "　", "﻿"]
    cases = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25))) for _ in range(600)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string")
    rows = df.select("i", py_strip("s").alias("st"), ascii_words("s").alias("w"),
                     reply_tail("s").alias("t"), json_block(reply_tail("s")).alias("b")).collect()
    for r in rows:
        s = cases[r.i]
        assert r.st == s.strip()
        assert r.w == re.findall(r"\b[a-z]+\b", s.lower())
        tail = s.split("[/INST]")[-1].strip()
        assert r.t == tail
        m = re.search(r"\{.*\}", tail, re.DOTALL)
        assert r.b == (m.group() if m else None)


# (type, severity, communication) of an object, and what cleaning makes of them
CLEANED = [
    ({"Ticket Type": " Complaints ", "Severity": "HIGH ", "Preferred Communication": "Not Specified"}, ("complaint", "high", "email")),
    ({"Ticket Type": "ENQUIRAY", "Severity": "urgent", "Preferred Communication": " Phone"}, ("inquiry", "medium", "phone")),
    ({"Ticket Type": "Request For Assistance", "Severity": "critical", "Preferred Communication": "chat"}, ("assistance", "critical", "chat")),
    ({"Ticket Type": "refund"}, ("complaint", "medium", None)),
    ({"Ticket Type": 5, "Severity": ["low"], "Preferred Communication": True}, ("complaint", "medium", None)),
    ({"Ticket Type": None, "Severity": None, "Preferred Communication": None}, ("complaint", "medium", None)),
]
# an object, and what the alternative loader makes of it (None: skipped)
LOADED = [
    ({}, ("inquiry", "medium", "email", None)),
    ({"Ticket Type": "Assistance "}, ("assistance ", "medium", "email", None)),
    ({"Ticket Type": "ASSISTANCE", "Severity": "Low"}, ("assistance", "low", "email", "general assistance")),
    ({"Ticket Type": None}, None),
    ({"Severity": 3}, None),
    ({"Preferred Communication": ["email"]}, None),
]


def _tickets(spark, cases):
    return spark.createDataFrame([(i, "t", json.dumps(d)) for i, (d, _) in enumerate(cases)],
                                 "row_index long, input string, output string")


def test_cleaning_of_listed_tickets(spark):
    from ticketloom.operators import clean as CL
    got = {r.row_index: (r.ticket_type, r.severity, r.preferred_communication)
           for r in CL.clean_tickets(CL.parse_tickets(_tickets(spark, CLEANED))).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CLEANED)}


def test_loading_of_listed_tickets(spark):
    from ticketloom.operators import records as RC
    got = {r.sample_id: (r.ticket_type, r.severity, r.preferred_communication, r.assistance_request) if r._ok else None
           for r in RC.load_with_defaults(_tickets(spark, LOADED)).collect()}
    assert got == {i: want for i, (_, want) in enumerate(LOADED)}


ERROR, FINE = '{"error": "e"}', '{"ticket_type": "inquiry", "severity": "low"}'
# truth, reply -> outcome, true label, predicted label
OUTCOMES = [
    (FINE, FINE, ("compared", "inquiry", "inquiry")),
    (FINE, '{"ticket_type": "complaint"}', ("compared", "inquiry", "complaint")),
    (FINE, "{}", ("compared", "inquiry", "unknown")),
    ("{}", FINE, ("compared", "unknown", "inquiry")),
    (FINE, ERROR, ("pred_error", "inquiry", "error")),
    (FINE, "no json", ("pred_error", "inquiry", "error")),
    (FINE, '{"a": 1} }', ("pred_error", "inquiry", "error")),
    ("{}", "no json", ("pred_error", "unknown", "error")),
    (ERROR, ERROR, ("both_error", "out_of_domain", "out_of_domain")),
    (ERROR, "no json", ("both_error", "out_of_domain", "out_of_domain")),
    (ERROR, '{"a": 1} }', ("both_error", "out_of_domain", "out_of_domain")),
    (ERROR, FINE, ("domain_error", "out_of_domain", "domain_error")),
    (FINE, None, ("pred_error", "inquiry", "error")),
]


def test_outcome_truth_table(spark):
    from ticketloom.operators import responses as RS
    truth = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(OUTCOMES)], "sample_id long, true_json string")
    reply = spark.createDataFrame([(i, "[INST] q [/INST] " + r) for i, (_, r, _) in enumerate(OUTCOMES) if r is not None]
                                  + [(99, "a prediction without a truth")], "sample_id long, response string")
    got = {r.sample_id: (r.outcome, r.true_label, r.pred_label) for r in RS.outcomes(RS.join_predictions(truth, reply)).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(OUTCOMES)}
