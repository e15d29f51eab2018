"""URL rules, hard negatives and conversation repair against brute force, with odd rows."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_check import compare
from ticketloom.llm import conversations, negatives, urls

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_url_rules", "op12_hard_negatives", "op13_conversation_repair"])
@pytest.mark.parametrize("sf", [SF001, SF01])
def test_oracles(spark, name, sf):
    assert compare(spark, name, E.queries()[name], E.oracle_sql()[name], sf)


# -- URL rules ------------------------------------------------------------------

def judged(spark, rows, **more):
    df = spark.createDataFrame(rows, "page_id long, url string").select(
        "*", *(F.lit(k).alias(c) for k, c in enumerate(["host", "path", "rule", "verdict", "tokens", "salt", "listed"])))
    return [r[:5] for r in urls.judge_urls(df, **more).orderBy("page_id", "host", "path").collect()]


def test_list_rules(spark):
    got = {u: r[1:] for (u, r) in zip(CASES, judged(spark, list(enumerate(CASES))))}
    assert got == CASES


CASES = {
    "http://a.net/": ("a.net", "/", "net/", "block"),
    "http://NET/x": ("net", "/x", "net/", "block"),
    "http://a.net": ("a.net", "", None, "allow"),                   # no path for the rule's to start
    "http://a.net?q=/": ("a.net", "", None, "allow"),
    "http://anet/x": ("anet", "/x", None, "allow"),
    "http://www.Example.NET/en/1#top": ("www.example.net", "/en/1", "example.net/en/", "allow"),
    "http://www.example.net/EN/1": ("www.example.net", "/EN/1", "net/", "block"),
    "http://badexample.net/en/1": ("badexample.net", "/en/1", "net/", "block"),
    "http://example.com/de/x://y.org/fr/": ("example.com", "/de/x://y.org/fr/", "example.com/de/", "block"),
    "ftp://x.org/fr/?a#b": ("x.org", "/fr/", "org/fr/", "allow"),
    "x.org/fr/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "http://a.net:80/x": ("a.net:80", "/x", None, "allow"),
    "http://a\nb.net/x\ny": ("a\nb.net", "/x\ny", "net/", "block"),
    "http://É.NET/": ("É.net", "/", "net/", "block"),
}


def brute_rules(rows, support, least, confidence):
    """Every token subset of the labelled rows, as {(subset, verdict): (confidence, hits)}."""
    n = len(rows)
    need = max(math.ceil(support * n), least)
    freq = {t for t in {t for ts, _ in rows for t in ts} if need <= sum(t in ts for ts, _ in rows) < n}
    subsets = {frozenset(c) for ts, _ in rows for k in range(1, len(freq & set(ts)) + 1)
               for c in itertools.combinations(sorted(freq & set(ts)), k)}
    out = {}
    for part in subsets:
        inside = [v for ts, v in rows if part <= set(ts)]
        for v in set(inside):
            if inside.count(v) >= need and inside.count(v) / len(inside) >= confidence:
                out[part, v] = (inside.count(v) / len(inside), inside.count(v))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_mined_rules(spark, seed):
    rnd = random.Random(seed)
    letters = "abcdefg"
    rows = [(sorted(rnd.sample(letters, rnd.randrange(0, 6))), rnd.choice(["block", "block", "allow"])) for _ in range(120)]
    rows = [(ts + (["b2", "b3"] if "b" in ts else []), "block" if {"a", "c"} <= set(ts) else v) for ts, v in rows]
    want = brute_rules(rows, 0.02, 3, 0.8)
    df = spark.createDataFrame(rows + [(["a"], None)], "tokens array<string>, verdict string")
    rules = urls.mine_rules(df, 0.02, 3, 0.8)
    probes = [(k, ts) for k, ts in enumerate(itertools.chain.from_iterable(
        itertools.combinations(list(letters) + ["b2"], r) for r in range(4)))]
    sets = spark.createDataFrame([(k, list(ts)) for k, ts in probes], "id long, tokens array<string>")
    got = {r.id: tuple(r.best) for r in urls.matches(sets, rules, "id").groupBy("id").agg(
        F.max(F.struct("confidence", "support", (F.col("verdict") == "allow").alias("mild"))).alias("best")).collect()}
    for k, ts in probes:
        hits = [(c, h, v == "allow") for (part, v), (c, h) in want.items() if part <= set(ts)]
        assert got.get(k) == (max(hits) if hits else None)
    kept = rules.collect()
    assert all(r.confidence == want[frozenset(m[0] for m in r.antecedent), r.verdict][0] for r in kept)
    for a, b in itertools.permutations(kept, 2):             # none is idle
        inside = {tuple(m) for m in a.antecedent} < {tuple(m) for m in b.antecedent}
        assert not (inside and a.verdict == b.verdict and a.confidence >= b.confidence)


def test_shuffled_rules_match_alike(spark, monkeypatch):
    rows = [(["a", "x"], "block")] * 6 + [(["b", "x"], "allow")] * 6 + [(["a", "b"], "allow")] * 3
    rules = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.01, 3, 0.9)
    sets = spark.createDataFrame([(k, list(t)) for k, t in enumerate(["ax", "bx", "ab", "abx", "q", ""])], "id long, tokens array<string>")
    one = sorted((r.id, r.rule_id) for r in urls.matches(sets, rules, "id").collect())
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    assert sorted((r.id, r.rule_id) for r in urls.matches(sets, rules, "id").collect()) == one and one


def test_hot_url_with_many_tokens_is_one_item(spark):
    """A third of the rows is one URL of 60 tokens: 2^60 combinations, and one rule."""
    hot = "http://h.com/" + "/".join(f"s{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60))
    labelled = spark.createDataFrame([(hot, "block")] * 40 + [(f"http://x{k % 5}.com/ok", "allow") for k in range(80)], "url string, verdict string")
    pages = [(1, hot), (2, "http://x1.com/ok"), (3, "http://new.com/saa"), (None, hot), (1, hot)]
    got = judged(spark, pages, labelled=labelled, rules=[("allow", "nowhere", "/")])
    assert sorted((r[0] or 0, r[4]) for r in got) == [(0, "block"), (1, "block"), (1, "block"), (2, "allow"), (3, "block")]


def test_url_edge_cases(spark):
    assert judged(spark, []) == []
    long = "http://l.com/" + "z" * 300_000 + "/" + "/".join(str(k) for k in range(20_000))
    got = judged(spark, [(1, long), (1, long), (None, None), (2, "http://a.net/x")])
    assert [r[4] for r in got] == ["allow", "allow", "allow", "block"]
    few = spark.createDataFrame([("http://a.com/x", "block")], "url string, verdict string")
    assert judged(spark, [(1, "http://a.com/x")], labelled=few) == [(1, "a.com", "/x", None, "allow")]      # too few rows for a rule


# -- hard negatives -------------------------------------------------------------

def brute_negatives(rows, divisor=50):
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    rank = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (ida, la, va) in enumerate(rows):
        if ida is None or ida % divisor:
            continue
        scored = [(dot(va, v), i, l == la) for b, (i, l, v) in enumerate(rows) if b != a]
        for p, pid, _ in sorted((r for r in scored if r[2]), key=rank)[:5]:
            inside = sorted((r for r in scored if not r[2] and 50 * p <= 100 * r[0] <= 95 * p), key=rank)[:3]
            out += [(ida, pid, k, i, p, n) for k, (n, i, _) in enumerate(inside, 1)]
    return sorted(out, key=str)


def mined(spark, rows, divisor=50):
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(3)
    return sorted(map(tuple, negatives.mine_hard_negatives(df, divisor).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_negatives(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "RUN_BITS", 4 + seed)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 7)
    rnd = random.Random(seed)
    size = [3, 8, 20][seed]
    rows = [(k, rnd.randrange(3), [rnd.randrange(-9, 10) for _ in range(size)]) for k in range(150)]
    rows += [(200 + k, 1, [0] * size) for k in range(3)] + [(300, 2, rows[4][2]), (350, 2, rows[4][2]), (None, 1, rows[5][2])]
    rows += [(400, 0, []), (401, 0, [5]), (402, 1, [5] * (size + 3)), (450, 1, rows[7][2][:2])]
    assert mined(spark, rows, 10) == brute_negatives(rows, 10)


def test_negatives_of_repeated_ids_and_large_numbers(spark):
    rows = [(0, 1, [3, 4]), (0, 1, [3, 4]), (1, 1, [6, 8]), (2, 2, [3, 3]), (2, 2, [3, 3]), (3, 2, [-3, 4]), (50, 2, [1, 0])]
    assert mined(spark, rows) == brute_negatives(rows)
    rows = [(k, k % 2, [10 ** 8 + k, -(10 ** 8) + 3 * k, 7 * 10 ** 7]) for k in range(30)]
    assert mined(spark, rows, 5) == brute_negatives(rows, 5)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, nan], 1), (1, [1.0, inf], 1), (2, [1.0, None], 1), (3, None, 1), (4, [0.5, -0.001], None), (5, [0.5, -0.001], 3), (6, [-inf], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").select("*", F.lit(1).alias("row_key"), F.lit(2).alias("g"))
    assert [tuple(r) for r in negatives.integer_vectors(df).collect()] == [(5, 3, [128, -1])]
    assert negatives.mine_hard_negatives(negatives.integer_vectors(df)).collect() == []
    assert negatives.mine_hard_negatives(negatives.integer_vectors(df.limit(0))).collect() == []


def test_bounds_hold_every_score():
    rnd = np.random.default_rng(5)
    for width in (2, 5, 64):
        x = rnd.integers(-200, 200, (300, width))
        x[:20] = x[20:40] * 2                       # parallel, opposite and equal vectors
        x[40:50] = -x[50:60]
        x[60] = 0
        refs = negatives.reference_directions(x[:100].tolist(), 8)
        norms = np.linalg.norm(x.astype(float), axis=1)
        angles = np.arccos(np.clip(x @ refs.T / np.where(norms > 0, norms, 1)[:, None], -1, 1)).astype("f4").astype(float)
        angles[norms == 0] = 0
        low, high = negatives.score_bounds(np.cos(angles), np.sin(angles), norms, np.cos(angles), np.sin(angles), norms, negatives.margin(width))
        exact = x @ x.T
        assert (low <= exact).all() and (exact <= high).all()
        if width == 2:                              # on a plane the bounds are nearly tight
            assert np.median(high - low) < 0.3 * np.median(np.abs(exact))


# -- conversations --------------------------------------------------------------

def brute_repair(rows):
    """Cheapest and then ASCII-least audit of ``(role, text, fault)`` rows, by trying all edits."""
    best = None

    def go(k, cost, audit, said):
        nonlocal best
        shape = "".join(r[:1] for r, _ in said)
        rest = shape[1:] if shape[:1] == "s" else shape
        if rest != ("ua" * len(rest))[:len(rest)] or (best and cost > best[0]):
            return
        if k == len(rows) and (not shape or (rest and len(rest) % 2 == 0)):
            best = min(best or (cost, audit, said), (cost, audit, said))
        if audit[-3:] != "III":
            for role in ("user", "assistant"):
                go(k, cost + 5, audit + "I", said + [(role, "")])
        if k < len(rows):
            role, text, fault = rows[k]
            go(k + 1, cost + 2, audit + "D", said)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] in ("s", "u", "a"):
                    go(k + 1, cost + more, audit + "K", said + [(role, text)])
                for new in ("user", "assistant"):
                    go(k + 1, cost + more + 1, audit + "R", said + [(new, text)])
    best = (2 * len(rows) + 1, "~", [])
    go(0, 0, "", [])
    return best


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.rstrip(conversations.BLANKS)
        out.append((role, text, "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


@pytest.mark.parametrize("width", [8, 96])
def test_repair_is_the_cheapest_and_least(monkeypatch, width):
    monkeypatch.setattr(conversations, "WIDTH", width)
    rnd = random.Random(width)
    roles = ["user", "assistant", "system", "tool", "", "u2"]
    for _ in range(400):
        rows = faults_of([(rnd.choice(roles[:rnd.randrange(2, 7)]), rnd.choice(["Hi.", "Go!", "Why", "", "No.", " \n", "Cut off", "x?"]))
                          for _ in range(rnd.randrange(0, 7))])
        said = []
        repair = conversations.Repair(lambda edit, turn, role, text: edit != "D" and said.append((role, text)))
        for row in rows:
            repair.add(None, *row)
        assert (*repair.close(), said) == brute_repair(rows), rows


def test_long_conversations_settle(monkeypatch):
    """Paths settle on the way: narrow weights give what wide ones give, and hold few rows."""
    rnd = random.Random(3)
    rows = faults_of([(rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice(["Hi.", "Go!", "Why", ""]) + str(rnd.randrange(50)) + rnd.choice([".", ""]))
                      for _ in range(3000)])
    out = []
    for width in (8, 20_000):
        monkeypatch.setattr(conversations, "WIDTH", width)
        said, most = [], 0
        repair = conversations.Repair(lambda *x: said.append(x))
        for k, row in enumerate(rows):
            repair.add(k, *row)
            most = max(most, len(repair.rows))
        out.append((repair.close(), said))
        if width == 8:
            assert repair.width <= 512 and most <= 512
    assert out[0] == out[1]


def report(spark, rows, harm=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", *(F.lit(k).alias(c) for k, c in enumerate(["kind", "copy", "digest", "seen", "fault", "present"])))
    rows = conversations.read_conversations(df)
    return {r.conv_id: r for r in conversations.repair_report(conversations.damage(rows) if harm else rows).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversation_edge_cases(spark):
    long = "word " * 200_000 + "end."
    got = report(spark, [
        (1, 5, "user", "Hi."), (1, None, "system", "Be good."), (1, 9, "assistant", long),
        (2, None, None, None), (2, None, "user", " \t"), (None, 1, "user", "A."), (None, 3, "assistant", "B."),
        (3, 1, "user", "A."), (3, 1, "user", "A."), (3, 1, "assistant", "B."), (3, 2, "user", "A.")])
    assert set(got) == {1, 2, 3, None}
    assert got[1][1:] == (3, 0, 0, 0, 0, 0, "KKK", sha(f"system:Be good.\nuser:Hi.\nassistant:{long}"))
    assert got[2][1:] == (0, 2, 0, 0, 1, 4, "DD", sha(""))
    assert got[None][1:] == (1, 0, 0, 0, 0, 0, "KK", sha("user:A.\nassistant:B."))
    # one turn: by role and text, so the assistant's row comes first
    assert got[3][1:] == (0, 0, 2, 0, 2, 6, got[3].audit, got[3].repaired_sha256) and got[3].audit == brute_repair(
        faults_of([("assistant", "B."), ("user", "A."), ("user", "A."), ("user", "A.")]))[1]
    assert report(spark, []) == {}


def test_conversation_of_dropped_rows(spark):
    import zlib
    gone = [(c, t) for c in range(60) for t in range(8) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    got = report(spark, [(c, t, "user", "Hi.") for c, t in gone], harm=True)
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "", sha("")) for r in got.values()) and len(got) == len({c for c, _ in gone})


def test_messages_make_the_hash(spark):
    rows = conversations.damage(conversations.read_conversations(spark.read.parquet(f"{SF01}/conversations.parquet")))
    said = {}
    for r in conversations.repaired_messages(rows).orderBy("conv_id", "place").collect():
        assert r.place == len(said.setdefault(r.conv_id, [])) and r.edit in "KRI"
        said[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(sha("\n".join(said.get(r.conv_id, []))) == r.repaired_sha256 for r in conversations.repair_report(rows).collect())


# -- calibration ----------------------------------------------------------------

def test_a_score_does_not_depend_on_its_batch():
    from ticketloom.llm.calibration import apply_logistic
    rnd = np.random.default_rng(7)
    for width in (1, 3, 5, 9):
        model = {"mean": rnd.normal(size=width), "scale": rnd.uniform(0.5, 2, width), "w": rnd.normal(size=width + 1)}
        x = rnd.normal(size=(257, width))
        alone = np.array([apply_logistic(model, x[k:k + 1])[0] for k in range(len(x))])
        for size in (2, 7, 64, 257):
            parts = np.concatenate([apply_logistic(model, x[k:k + size]) for k in range(0, len(x), size)])
            assert (parts == alone).all()
