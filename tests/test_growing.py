"""Phrase lists, heavy words and day summaries against plain Python."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF001
from ticketloom.operators import heavy as HV
from ticketloom.operators import keywords as KW
from ticketloom.operators import phrases as PH
from ticketloom.operators import summaries as SU
from ticketloom.session import scratch_path
from ticketloom.sources.tables import read_table


def _word(r, n):
    return "".join(r.choice("abcdefgh") for _ in range(n))


def _brute(texts, phrases):
    listed = {tuple(p.split()) for p in phrases if p.split()}
    longest = max(map(len, listed))
    return {i: Counter(" ".join(w[a:b]) for w in [t.split()] for a in range(len(w)) for b in range(a + 1, min(len(w), a + longest) + 1)
                       if tuple(w[a:b]) in listed) for i, t in texts.items()}


def test_many_phrases_equal_brute_force(spark):
    r = random.Random(3)
    phrases = list({" ".join(_word(r, r.choice((1, 2, 3))) for _ in range(r.randint(1, 4))) for _ in range(180_000)})
    phrases = sorted(phrases)[:100_000]
    assert len(phrases) == 100_000
    texts = {i: " ".join(_word(r, r.choice((1, 2, 3))) for _ in range(r.choice((0, 1, 5, 300)))) for i in range(60)}
    texts[60] = "the hot phrase " * 5000
    phrases += ["the hot phrase", "hot phrase the", "", "  ", "the hot phrase"]
    rows = spark.createDataFrame([*texts.items(), (61, None)], "id long, text string")
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    want = _brute(texts, phrases)
    for limit in (PH.BROADCAST_BYTES, 0):                   # broadcast, and shuffled with salts
        got = PH.phrase_matches(rows, table, "id", "text", broadcast_bytes=limit)
        counts = {(x.id, x.phrase): x.n for x in got.groupBy("id", "phrase").agg(F.count("*").alias("n")).collect()}
        assert counts == {(i, p): n for i, c in want.items() for p, n in c.items()}
    scored = {x.id: x for x in PH.phrase_scores(rows, table, "id", "text", threshold=2).collect()}
    assert set(scored) == {*texts, 61} and not scored[61].in_domain and scored[61].error and scored[61].n_matches == 0
    assert all((scored[i].n_matches, scored[i].n_phrases, scored[i].in_domain) == (sum(c.values()), len(c), len(c) >= 2)
               for i, c in want.items())


def test_runs_are_read_off_rows(spark):
    """Short runs need no function per word, and each text is cut once; long runs give the same rows."""
    texts = [(1, "one two  THREE four x1 five"), (2, "a"), (3, ""), (4, None), (None, "b a"), (5, " ".join(f"w{chr(97 + k)}" for k in range(20)))]
    rows = spark.createDataFrame(texts, "id long, text string").coalesce(1)

    def want(lengths):
        cut = [(i, [x for x in re.findall(r"\w+", (t or "").lower()) if re.fullmatch("[a-z]+", x)]) for i, t in texts]
        return Counter((i, k, " ".join(w[k:k + n])) for i, w in cut for n in lengths for k in range(len(w) - n + 1))

    for lengths in ([1], [2, 3], [1, 8], [1, 3, 12]):
        assert Counter(map(tuple, PH.word_runs(rows, "id", "text", lengths).collect())) == want(lengths)
    plan = PH.word_runs(rows, "id", "text", [1, 2, 3])._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and plan.count("regexp_extract_all") == 1


def test_phrases_without_list_or_rows(spark):
    rows = spark.createDataFrame([(1, "a b")], "id long, text string")
    none = spark.createDataFrame([(None,), ("12 !",)], "phrase string")
    assert PH.phrase_matches(rows, none, "id", "text").isEmpty()
    assert [tuple(x)[:4] for x in PH.phrase_scores(rows, none, "id", "text").collect()] == [(1, 0, 0, False)]
    some = spark.createDataFrame([("a",)], "phrase string")
    assert PH.phrase_scores(rows.limit(0), some, "id", "text").isEmpty()


def test_heavy_words_miss_none(spark):
    r = random.Random(5)
    rows = [(r.choice(("x", "y", None)), " ".join(_word(r, r.choice((1, 1, 2, 4))) for _ in range(40))) for _ in range(120)]
    rows += [("few", "aa bb aa"), ("ties", " ".join(_word(r, 5) for _ in range(60))), ("none", None), ("none", "")]
    df = spark.createDataFrame(rows, "c string, text string")
    want = sorted(map(str, KW.top_keywords(KW.word_counts(df, "text", "c"), ["c"], 20, []).collect()))
    for buckets, chosen in ((1, 10**6), (7, 10**6), (1 << 12, 10**6), (1 << 16, 10**6), (64, 0), (1 << 16, 100)):
        counts = HV.heavy_word_counts(df, "text", ["c"], 20, buckets, chosen)
        assert sorted(map(str, KW.top_keywords(counts, ["c"], 20, []).collect())) == want, (buckets, chosen)


def test_heavy_words_shuffle_fewer(spark):
    """A long tail stays out of the recount: far fewer words than the vocabulary are counted exactly."""
    r = random.Random(6)
    tail = spark.createDataFrame([("x", " ".join(["often", "again", "more"] * 30 + [_word(r, 9) for _ in range(400)])) for _ in range(100)],
                                 "c string, text string")
    assert KW.word_counts(tail, "text", "c").count() > 30_000
    assert HV.heavy_word_counts(tail, "text", ["c"], 3).count() < 50


def test_day_summaries_grow_and_repeat(spark):
    docs = read_table(spark, SF001, "documents", "doc_id", "lang", "text").withColumn("day", F.pmod("doc_id", F.lit(5)))
    docs = docs.unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    path = scratch_path(spark, "summaries_test")

    def add(days):
        SU.store_summaries(SU.day_summaries(docs.where(F.col("day").isin(days)), "day", ["lang"], "text", ["text"]), "day", path)

    def profile():
        merged = SU.merge_summaries(SU.read_summaries(spark, path), ["lang"])
        return SU.check_profile(SU.summary_profile(merged, ["lang"]), docs, ["lang"], "text", ["text"]).orderBy("lang").collect()

    add([0, 1, 2, 3])
    add([4])
    first = profile()
    add([4])                                                   # a repeated run replaces the day
    assert profile() == first
    full = docs.groupBy("lang").agg(F.count("*").alias("r"), F.count("text").alias("t"), F.round(F.avg(F.length("text")), 6).alias("m"),
                                    F.round(F.stddev_samp(F.length("text")), 6).alias("s")).orderBy("lang").collect()
    assert [(x.n_rows, x.n_texts, x.mean, round(x.std, 5)) for x in first] == [(x.r, x.t, x.m, round(x.s, 5)) for x in full]
    assert all(x.median_within and x.text_within for x in first)


def test_day_summaries_of_nothing(spark):
    rows = spark.createDataFrame([(1, None, None)], "day int, g string, text string")
    merged = SU.merge_summaries(SU.day_summaries(rows, "day", ["g"], "text", ["text"]), ["g"])
    got = SU.summary_profile(merged, ["g"]).collect()
    assert [(x.n_rows, x.n_texts, x.mean, x.std, x.median, x.unique_text) for x in got] == [(1, 0, None, None, None, 0)]
