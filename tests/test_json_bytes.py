"""The bytes of Python's json module, from column expressions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ticketloom.functions import jsonx

STRINGS = ["", "plain", 'q"uote', "back\\slash", "tab\tnl\ncr\rbs\bff\f", "\x00\x01\x1f\x7f", "é ß 中 \u2028", "🎉 \U0010ffff", "a/b", "\\u0041",
           "mixed é\"\\🎉 end", " ", "x" * 20_000, "\n" * 20_000, "\ufeff"]
NUMBERS = ["0", "-0", "7", "-12", "123456789012345678901234567890", "1.0", "-0.0", "0.1", "1.50", "100.0", "1e5", "1E+2", "1e16", "1e15", "123456789.125",
           "1e-4", "1e-5", "0.00012345", "1.7976931348623157e308", "1e400", "-1e400", "12345678901234567890.0", "3.141592653589793", "2e-7", "9007199254740993.0"]


def values(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 4 else 4)
    if kind < 2:
        return rnd.choice(STRINGS[:12])
    if kind < 4:
        return rnd.choice([None, True, False, 5, -1, 2.5, 1e22, 1e-9])
    if kind < 6:
        return [values(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {rnd.choice(STRINGS[:12]) + str(k): values(rnd, depth + 1) for k in range(rnd.randrange(4))}


def test_strings(spark):
    rows = spark.createDataFrame([(k, s) for k, s in enumerate([*STRINGS, None])], "k int, s string")
    got = {r.k: r.v for r in rows.select("k", jsonx.py_quote("s").alias("v")).collect()}
    assert [got[k] for k in range(len(got))] == [json.dumps(s) for s in [*STRINGS, None]]


def dumped(spark, texts, indent=2, level=0):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(4)
    got = {r.k: r.v for r in rows.select("k", jsonx.py_dumps("t", indent, level).alias("v")).collect()}
    return [got[k] for k in range(len(texts))]


def test_numbers_and_words(spark):
    texts = NUMBERS + ["true", "false", "null", "NaN", "Infinity", "-Infinity"]
    assert dumped(spark, texts) == [json.dumps(json.loads(t)) for t in texts]


def test_escapes(spark):
    texts = [r'"\u00e9\u00E9\ud83c\udf89\ud83c\/\b\f\n\r\t\"\\ \u0041\u001f\u007f\u0022\u005c"', '"é🎉"', '"\x7f"']
    assert dumped(spark, texts) == [json.dumps(json.loads(t)) for t in texts]


@pytest.mark.parametrize("indent", [2, 4])
def test_nested(spark, indent):
    rnd = random.Random(indent)
    data = [values(rnd) for _ in range(150)] + [[], {}, [[]], [{}], {"a": {}}, {"a": []}, [[], {}], {"b": 1, "a": 2}]
    for form in ({"ensure_ascii": False}, {"indent": 1}, {"separators": (",", ":")}):
        assert dumped(spark, [json.dumps(d, **form) for d in data], indent) == [json.dumps(d, indent=indent) for d in data]


def test_level(spark):
    data = [{"a": [1, {}], "b": "é"}, 5, [[]]]
    got = dumped(spark, [json.dumps(d) for d in data], 2, 1)
    assert "[\n  " + ",\n  ".join(got) + "\n]" == json.dumps(data, indent=2)
