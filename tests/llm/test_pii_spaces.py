"""Surrogates in crowded formats, and people who share names, against a plain checker."""

import re

import pytest
from pyspark.sql import functions as F

from ticketloom.llm import pii


def replaced(spark, texts, **more):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.surrogate_pii(rows, **more).collect()}
    return [got[k] for k in range(len(texts))]


def check(old, new):
    """One replacement for each old form, none shared, none real."""
    pairs = dict(zip(old, new))
    assert all(pairs[a] == b for a, b in zip(old, new))
    assert len(set(pairs.values())) == len(pairs)
    assert not set(pairs.values()) & set(pairs)


def test_a_surrogate_is_not_replaced_again(spark):
    text = "Mr John Smith met Mr Peter Paul. John and Paul left."
    (out,) = replaced(spark, [text])
    given1, sur1, given2, sur2, later1, later2 = re.fullmatch(r"Mr (\w+) (\w+) met Mr (\w+) (\w+)\. (\w+) and (\w+) left\.", out).groups()
    assert (later1, later2) == (given1, sur2) and len({given1, sur1, given2, sur2}) == 4
    assert not {given1, sur1, given2, sur2} & {"John", "Smith", "Peter", "Paul"}


@pytest.mark.parametrize("key", ["a", "b", "c"])
def test_names_of_both_sorts_are_one_space(spark, key):
    """Everybody's surname is somebody's given name."""
    names = pii.GIVEN["latin_m"].split()
    texts = [f"Mr {a} {b} came. {a} and {b}." for a, b in zip(names, names[1:] + names[:1]) if a != b]
    out = replaced(spark, texts, key=key)
    parts = [re.fullmatch(r"Mr (\w+) (\w+) came\. (\w+) and (\w+)\.", t).groups() for t in out]
    assert all(p[:2] == p[2:] for p in parts)
    assert len({p[0] for p in parts} | {p[1] for p in parts}) == 2 * len(names)
    assert not ({p[0] for p in parts} | {p[1] for p in parts}) & set(names)


@pytest.mark.parametrize("locals_", [[f"{k:02d}" for k in range(100)], [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"],
                                     list("abcdefghijklmnopqrstuvwxyz")])
def test_crowded_locals_of_one_domain(spark, locals_):
    old = [f"{x}@mail.example.com" for x in locals_] + [f"{x.upper()}@mail.example.com" for x in locals_[:5]]
    new = [t[4:] for t in replaced(spark, [f"to: {x}" for x in old])]
    check([x.lower() for x in old], [x.lower() for x in new])
    assert len({x.split("@")[1].lower() for x in new}) == 1


def test_short_phones(spark):
    old = [f"+12 {k:02d} {m:02d}" for k in range(40) for m in range(100)]
    new = [t[5:] for t in replaced(spark, [f"call {x}" for x in old])]
    digits = lambda xs: [re.sub(r"\D", "", x) for x in xs]
    check(digits(old), digits(new))
    assert all(x.startswith("+12 ") for x in new)


def test_five_thousand_given_names(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"{a.upper()}{b}{c}ra" for a in letters for b in letters for c in letters][:5000]
    new = [t for t in replaced(spark, [f"Mrs {n} Smith" for n in names])]
    given = [re.fullmatch(r"Mrs (\p{L}+) (\p{L}+)".replace(r"\p{L}", r"[^\W\d_]"), t).groups() for t in new]
    check(names, [g for g, _ in given])
    assert len({s for _, s in given}) == 1
    ends = tuple(pii.ENDINGS["latin_f"])
    assert all(g.endswith(ends) or g in pii.GIVEN["latin_f"].split() for g, _ in given)


def test_digits_without_a_check_digit_stay(spark):
    texts = ["pay 4845168114407329 now", "part 4845168114407328 here", "id 0810992847249404 and 4845 1681 1440 7329", "+1 (843) 555-7672 170.106.47.21"]
    out = replaced(spark, texts, check_digits=True)
    assert out[1] == texts[1] and out[2].startswith("id 0810992847249404 and ") and out[2] != texts[2]
    card = re.fullmatch(r"pay (\d{16}) now", out[0]).group(1)
    assert re.sub(" ", "", out[2][-19:]) == card and card != "4845168114407329"
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4} \d+\.\d+\.\d+\.\d+", out[3]) and "555-7672" not in out[3] and "170.106" not in out[3]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n for r in pii.surrogate_pii(rows, count_col="n", check_digits=True).orderBy("doc_id").collect()] == [1, 0, 1, 2]
    # without the check every number of a card's length goes
    assert "4845168114407328" not in replaced(spark, texts)[1]
