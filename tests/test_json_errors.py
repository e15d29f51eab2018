"""The decoder's first error against Python's own."""

import json
import random
import sys

import pytest
from pyspark.sql import functions as F

from ticketloom.functions.json_errors import error_text, first_error
from ticketloom.functions.jsonx import materialize

LISTED = [
    "", " ", "{", "}", "[", "]", "{}", "[]", '{"a"', '{"a":', '{"a": 1', '{"a": 1,', '{"a": 1, }', "[1, ]", "[1,", "[,1]", "{,}", '{"a" 1}', "{'a': 1}",
    '{"a": 1} x', '{"a": 1}{', "[1 2]", '{"a": 1 "b": 2}', '{"a": tru}', "nullx", "01", "1.", "1e", "-", "-x", "+1", ".5", "NaN", "-Infinity", "Infinit",
    '"abc', '"ab\\', '"a\\x"', '"a\\u12', '"a\\u12g4"', '"a\\u1234', '"a\nb"', '"a\tb', '{"a\x00": 1}', '{"a": "b\\q"}', '{\n "a": 1,\n "b" 2}', "﻿{}",
    '{"é🎉": 1, "b": }', '[\n\n1\n,\n\n]', '{"a": [1, {"b": [}]}', '{"a": 1]', "[1}", '[[[[[', '{"a":{"b":{"c":1}}', "\x0b1", " 1", '["\\ud83c", "\\/"] ,',
    '{"a": "x" "y"}', '{"a"; 1}', '{1: 2}', '{"a": 1,, "b": 2}', '"\x7f"', "tRue", "[true false]", '{"k": "' + "v" * 5000 + '"', "[" * 300, '{"a": "' + "\\n" * 9000 + "\x01"]


def said(text):
    try:
        json.loads(text)
    except json.JSONDecodeError as e:
        return str(e)
    return None


def compare(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(8)
    rows = materialize(rows, e=first_error(F.col("t"), sys.version_info >= (3, 13)))
    got = {r.k: r.m for r in rows.select("k", error_text(F.col("t"), F.col("e")).alias("m")).collect()}
    for k, t in enumerate(texts):
        assert got[k] == said(t), repr(t[:200])


def test_listed(spark):
    compare(spark, LISTED)


@pytest.mark.parametrize("seed", [1, 2])
def test_fuzz(spark, seed):
    rnd = random.Random(seed)
    base = ['{"ticket_type": "inquiry", "n": [1, -2.5e3, null, {"x": "\\u00e9\\n"}], "d": {}}', '[[], {"a": true}, "b\\\\", 0]',
            '{\n  "a": {\n    "b": [\n      1,\n      2\n    ]\n  }\n}']
    texts = []
    for _ in range(700):
        t = list(rnd.choice(base))
        for _ in range(rnd.randrange(1, 4)):
            k = rnd.randrange(len(t) + 1)
            kind = rnd.randrange(3)
            if kind == 0 and k < len(t):
                del t[k:k + rnd.randrange(1, 4)]
            elif kind == 1:
                t.insert(k, rnd.choice('{}[],:"\\ \n\t0e-.x\x01é'))
            elif k < len(t):
                t[k] = rnd.choice('{}[],:"\\u1 \n')
            if not t:
                t = ["{"]
        texts.append("".join(t))
    compare(spark, texts)


def test_older_wording_and_null(spark):
    rows = spark.createDataFrame([('{"a": 1, }',), ("[1, ]",), (None,)], "t string")
    rows = materialize(rows, e=first_error(F.col("t"), False))
    got = [r.m for r in rows.select(error_text(F.col("t"), F.col("e")).alias("m")).collect()]
    assert got == ["Expecting property name enclosed in double quotes: line 1 column 10 (char 9)", "Expecting value: line 1 column 5 (char 4)", None]
