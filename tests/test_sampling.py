"""Invariants of balancing and splitting: exact sizes, repeatability,
independence from the number of partitions."""

from pyspark.sql import functions as F

from ticketloom.operators import sampling as SM


def _classes(spark, sizes):
    rows, i = [], 0
    for cls, n in sizes.items():
        for _ in range(n):
            rows.append((i, cls))
            i += 1
    return spark.createDataFrame(rows, "id long, cls string")


def test_balance_exact_sizes(spark):
    n = 20
    sizes = {"one": 1, "below": n - 1, "exact": n, "above": n + 1, "big": 3 * n + 7}
    out = SM.balance_classes(_classes(spark, sizes), "cls", "id", target=n, digits=1)
    counts = {r.cls: r.c for r in out.groupBy("cls").agg(F.count("*").alias("c")).collect()}
    assert counts == {c: n for c in sizes}
    # every row of a small class appears once as itself (draw 0)
    originals = out.where("draw = 0").groupBy("cls").count().collect()
    assert {r.cls: r["count"] for r in originals} == {c: min(s, n) for c, s in sizes.items()}
    # positions form 0..N-1 exactly
    pos = sorted(r.pos for r in out.select("pos").collect())
    assert pos == list(range(len(sizes) * n))


def test_balance_empty_input(spark):
    out = SM.balance_classes(_classes(spark, {}), "cls", "id", target=5)
    assert out.count() == 0


def test_split_sizes_match_python_int(spark):
    for n in (0, 1, 9, 10, 100):
        df = spark.range(n).withColumnRenamed("id", "sid")
        out = SM.split_three_way(df, ["sid"], (0.8, 0.1, 0.1))
        got = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
        t = int(n * 0.8)
        v = int(n * 0.1)
        exp = {"train": t, "validation": v, "test": n - t - v}
        assert {k: got.get(k, 0) for k in exp} == exp, n


def test_split_ratio_is_binary_double(spark):
    df = spark.range(100).withColumnRenamed("id", "sid")
    out = SM.split_three_way(df, ["sid"], (0.29, 0.1, 0.61))
    assert out.where("split = 'train'").count() == int(100 * 0.29) == 28


def test_train_eval_validation_inside_test(spark):
    df = spark.range(101).withColumnRenamed("id", "sid")
    out = SM.split_train_eval(df, ["sid"], 0.9)
    c = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert c == {"train": 90, "test": 11, "validation": 5}
    val = {r.sid for r in out.where("split='validation'").collect()}
    test = {r.sid for r in out.where("split='test'").collect()}
    assert val <= test
    dis = SM.split_train_eval(df, ["sid"], 0.9, disjoint=True)
    assert dis.count() == 101


def test_partition_count_independent(spark):
    df = spark.range(500).withColumnRenamed("id", "sid")
    a = {(r.sid, r.split) for r in SM.split_three_way(df.repartition(1), ["sid"]).collect()}
    b = {(r.sid, r.split) for r in SM.split_three_way(df.repartition(13), ["sid"]).collect()}
    assert a == b
    s1 = {(r.sid, r.pos) for r in SM.shuffle_rows(df.repartition(1), "sid").collect()}
    s2 = {(r.sid, r.pos) for r in SM.shuffle_rows(df.repartition(7), "sid").collect()}
    assert s1 == s2


def test_ratio_warning():
    assert SM.check_ratios(0.8, 0.1, 0.1) is None
    assert "not 1.0" in SM.check_ratios(0.8, 0.1, 0.2)


def test_balance_hot_and_null_classes(spark):
    # one class holds a third of all rows, and a null class is a class
    rows = [(i, "hot" if i % 3 == 0 else ("c%d" % (i % 7))) for i in range(3000)]
    rows += [(10_000 + i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, cls string")
    n = 150
    out = SM.balance_classes(df, "cls", "id", target=n, digits=2)
    counts = {r.cls: r["count"] for r in out.groupBy("cls").count().collect()}
    assert set(counts.values()) == {n}
    assert None in counts and "hot" in counts
    # the hot class keeps its first n rows in hash order, the same as a full sort
    import hashlib
    hot = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i, c in rows if c == "hot")
    assert {r.id for r in out.where("cls = 'hot'").collect()} == {i for _, i in hot[:n]}


def test_rank_window_is_partitioned_by_bucket(spark):
    from ticketloom.operators import rank as R
    df = spark.range(1000).withColumn("cls", (F.col("id") % 2).cast("string"))
    p = R.positions(df, R.hash_key(42, "id"), ["id"], by=["cls"])
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    got = {(r.cls, r.pos) for r in p.collect()}
    assert len(got) == 1000 and max(pos for _, pos in got) == 499


def _md5(s):
    import hashlib
    return hashlib.md5(s.encode()).hexdigest()


def test_split_fuzz_against_python_rule(spark):
    """Random sizes and ratios, 1-2 hex digit buckets (many rows per bucket,
    straddling cuts): labels equal a plain sort by md5 cut at int(n*r)."""
    import random
    from ticketloom.operators import rank as R
    rnd = random.Random(4)
    for _ in range(6):
        n = rnd.randint(0, 400)
        r1, r2 = round(rnd.uniform(0.05, 0.7), 3), round(rnd.uniform(0.0, 0.25), 3)
        digits = rnd.choice([1, 2])
        df = spark.range(n).withColumnRenamed("id", "sid")
        t_end = int(n * r1)
        v_end = t_end + int(n * r2)
        out, _, _ = R.segments(df, R.hash_key(42, "sid"), ["sid"], lambda m: [int(m * r1), int(m * r1) + int(m * r2)],
                               ["train", "validation", "test"], name="split", digits=digits)
        got = {r.sid: r.split for r in out.collect()}
        order = sorted(range(n), key=lambda i: (_md5(f"42:{i}"), i))
        exp = {i: ("train" if p < t_end else "validation" if p < v_end else "test") for p, i in enumerate(order)}
        assert got == exp, (n, r1, r2, digits)


def test_balance_fuzz_against_python_rule(spark):
    import random
    rnd = random.Random(8)
    for _ in range(3):
        sizes = {f"c{k}": rnd.randint(1, 60) for k in range(rnd.randint(1, 4))}
        target = rnd.randint(1, 50)
        rows, i = [], 0
        for c, s in sizes.items():
            for _ in range(s):
                rows.append((i, c))
                i += 1
        df = spark.createDataFrame(rows, "id long, cls string")
        out = SM.balance_classes(df, "cls", "id", target=target, digits=1)
        got = sorted((r.cls, r.id, r.draw, r.pos) for r in out.collect())
        picked = []
        for c in sizes:
            ids = sorted((x for x, cc in rows if cc == c), key=lambda x: (_md5(f"42:{x}"), x))
            n = len(ids)
            picked += [(c, x, 0) for x in ids[:target]]
            for j in range(1, target - n + 1):
                picked.append((c, ids[int(_md5(f"42:{c}:{j}")[:15], 16) % n], j))
        order = sorted(picked, key=lambda t: (_md5(f"42:{t[0]}:{t[1]}:{t[2]}"), t[0], t[1], t[2]))
        exp = sorted((c, x, d, p) for p, (c, x, d) in enumerate(order))
        assert got == exp, (sizes, target)


def test_split_leakage_hot_and_null_texts(spark):
    rows = []
    for i in range(900):
        split = "train" if i % 3 else "test"
        text = "hot" if i % 2 == 0 else (None if i % 7 == 0 else f"t{i % 40}")
        rows.append((i, split, text))
    df = spark.createDataFrame(rows, "sample_id long, split string, user_input string")
    got = {r.sample_id for r in SM.split_leakage(df).collect()}
    train = {t for _, s, t in rows if s == "train" and t is not None}
    exp = {i for i, s, t in rows if s == "test" and t is not None and t in train}
    assert got == exp and len(exp) > 100


def test_many_cuts_read_the_rows_three_times(spark, monkeypatch):
    from ticketloom.operators import rank as R
    monkeypatch.setattr(R, "BOUNDARY_ROWS", 5)
    n, cuts = 3000, [0, 1, 299, 300, 1500, 2999, 3000, 4000]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(n).withColumnRenamed("id", "k").mapInArrow(count, "k long")
    out, total, got = R.segments(df, R.hash_key(7, "k"), ["k"], lambda _: cuts, [f"s{i}" for i in range(9)], digits=1)
    labels = {r.k: r.segment for r in out.collect()}
    import hashlib
    order = sorted(range(n), key=lambda k: (hashlib.md5(f"7:{k}".encode()).hexdigest(), k))
    want = {k: f"s{sum(c <= p for c in cuts)}" for p, k in enumerate(order)}
    assert labels == want and total == n and got == cuts and seen.value == 3 * n
