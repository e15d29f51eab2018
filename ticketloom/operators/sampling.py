"""Balancing, shuffling and splitting (B1-B4, U2-U5, A17, split leakage).

All of them rest on ``rank``: positions come from md5 order, so results are
exact (sizes to the row), repeatable, independent of partitioning, and the
same in the DuckDB oracle.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.fixed_values import (
    BALANCE_TARGET, RATIO_TOLERANCE, SEED, SPLIT_RATIOS, TRAIN_RATIO, VALIDATION_SHARE_OF_TEST)
from ticketloom.operators import rank as R
from ticketloom.operators.profile import text_digest


DRAW_BLOCK = 10_000


def balance_classes(df: DataFrame, class_col: str, id_col: str, target: int = BALANCE_TARGET,
                    seed: int = SEED, digits: int = R.DEFAULT_DIGITS) -> DataFrame:
    """B1: exactly ``target`` rows per class, then shuffled (B2).

    A class with at least ``target`` rows keeps its first ``target`` rows in
    hash order (only the one bucket straddling the cut is ranked).  A
    smaller class keeps all its rows once and adds ``target - n`` draws with
    replacement: draw j takes the row at position hash(seed:class:j) mod n.
    Output: input columns + ``draw`` (0 = the row itself, j >= 1 = j-th
    draw) + ``pos`` (position after the final shuffle)."""
    key = R.hash_key(seed, id_col)
    d, offsets = R.bucket_offsets(df, key, [class_col], digits)
    j = R.join_offsets(d, offsets, [class_col])
    n_, off, cnt = F.col("_n"), F.col("_off"), F.col("_cnt")
    small = n_ < target
    straddle = (off < target) & (off + cnt > target)
    need = small | straddle
    cols = df.columns
    whole = j.where(~need & (off + cnt <= target)).select(*cols)
    w = Window.partitionBy(class_col, "_b").orderBy("_h", id_col)
    ranked = (j.where(need).withColumn("_pos", off + F.row_number().over(w) - 1)
              .select(*cols, "_pos", "_n").checkpoint(eager=True))
    kept = whole.unionByName(ranked.where(F.col("_pos") < target).select(*cols))
    kept = kept.withColumn("draw", F.lit(0))
    classes = offsets.where(F.col("_n") < target).select(class_col, "_n").distinct()
    # draws in blocks, dealt out before they are listed: no task or array holds all of a class
    last = F.lit(target) - F.col("_n")
    blocks = classes.select(class_col, "_n", F.explode(F.sequence(F.lit(0), F.floor((last - 1) / DRAW_BLOCK))).alias("_block"))
    first = F.col("_block") * DRAW_BLOCK
    draws = blocks.repartition(class_col, "_block").select(class_col, "_n", F.explode(
        F.sequence(first + 1, F.least(first + DRAW_BLOCK, last)).cast("array<int>")).alias("draw"))
    draws = draws.withColumn("_idx", F.pmod(R.hash_int(seed, class_col, "draw"), F.col("_n")))
    picked = ranked.select(*[F.col(c).alias(f"_r_{c}") for c in cols], F.col("_pos").alias("_r_pos"))
    drawn = (draws.join(picked, F.col(class_col).eqNullSafe(F.col(f"_r_{class_col}"))
                        & (F.col("_idx") == F.col("_r_pos")))
             .select(*[F.col(f"_r_{c}").alias(c) for c in cols], "draw"))
    balanced = kept.unionByName(drawn).checkpoint(eager=True)
    return R.positions(balanced, R.hash_key(seed, class_col, id_col, "draw"),
                       [class_col, id_col, "draw"], name="pos", digits=digits)


def shuffle_rows(df: DataFrame, id_col: str, seed: int = SEED) -> DataFrame:
    """B2: a global, repeatable shuffle as an explicit position column."""
    return R.positions(df, R.hash_key(seed, id_col), [id_col], name="pos")


def check_ratios(r1: float, r2: float, r3: float) -> str | None:
    """warning text when the ratios do not sum to 1 (+- 0.001)."""
    total = r1 + r2 + r3
    if abs(total - 1.0) > RATIO_TOLERANCE:
        return f"Warning: ratios sum to {total}, not 1.0"
    return None


def split_three_way(samples: DataFrame, id_cols: list[str], ratios=SPLIT_RATIOS,
                    seed: int = SEED, extra_test: DataFrame | None = None,
                    digits: int = R.DEFAULT_DIGITS) -> DataFrame:
    """train = first int(n*r1) rows in hash order, validation the next
    int(n*r2), test the rest (r3 unused); ``extra_test`` rows (the
    out-of-domain set) are appended to test (U2)."""
    r1, r2 = float(ratios[0]), float(ratios[1])
    note = check_ratios(*[float(r) for r in ratios])
    if note:
        warnings.warn(note, stacklevel=2)

    def cuts(n: int):
        train_end = int(n * r1)
        return [train_end, train_end + int(n * r2)]

    out, _, _ = R.segments(samples, R.hash_key(seed, *id_cols), list(id_cols), cuts,
                           ["train", "validation", "test"], name="split", digits=digits)
    if extra_test is not None:
        out = out.unionByName(extra_test.withColumn("split", F.lit("test")), allowMissingColumns=True)
    return out


def split_train_eval(samples: DataFrame, id_cols: list[str], train_ratio: float = TRAIN_RATIO,
                     seed: int = SEED, disjoint: bool = False) -> DataFrame:
    """train = first int(n*ratio); test = the rest; validation = the
    first int(len(test)*0.5) rows of test, so validation is inside test
    unless ``disjoint``.  Rows in both get two output rows."""
    r = float(train_ratio)

    def cuts(n: int):
        train_end = int(n * r)
        return [train_end, train_end + int((n - train_end) * VALIDATION_SHARE_OF_TEST)]

    out, _, _ = R.segments(samples, R.hash_key(seed, *id_cols), list(id_cols), cuts,
                           ["train", "both", "test"], name="_seg")
    both = ["validation"] if disjoint else ["validation", "test"]
    member = (F.when(F.col("_seg") == "both", F.array(*[F.lit(x) for x in both]))
              .otherwise(F.array(F.col("_seg"))))
    return out.withColumn("split", F.explode(member)).drop("_seg")


LEAKAGE_SALTS = 64


def split_leakage(splits: DataFrame, text_col: str = "user_input", id_col: str = "sample_id",
                  salts: int = LEAKAGE_SALTS) -> DataFrame:
    """Ids of the test rows whose input text also occurs in train, salted
    against hot texts.  The rows are reduced once to (id, split, digest,
    salt) in the shared checkpoint folder; the distinct (digest, salt) pairs
    of the test rows meet the distinct train digests on the digest (at most
    ``salts`` rows per key on one side, one on the other); test rows then
    semi-join the leaked pairs on (digest, salt), so a text held by a third
    of the rows is spread over ``salts`` keys.  A null text never leaks (as
    with SQL ``IN``)."""
    rows = splits.select(F.col(id_col), "split", text_digest(text_col).alias("_h"),
                         F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias("_s"))
    rows = rows.where(F.col("_h").isNotNull() & F.col("split").isin("train", "test")).checkpoint(eager=True)
    test = rows.where(F.col("split") == "test")
    train = rows.where(F.col("split") == "train").select("_h").distinct()
    leaked = test.select("_h", "_s").distinct().join(train, "_h", "left_semi")
    return test.join(leaked, ["_h", "_s"], "left_semi").select(id_col)


def split_distribution(splits: DataFrame) -> DataFrame:
    """Per split the total (error rows included), and type and
    severity counts without error rows (missing -> 'unknown'), from one
    GROUPING SETS aggregate: (split, dim, value, n)."""
    ok = F.col("error").isNull()
    t = F.when(ok, F.coalesce(F.col("ticket_type"), F.lit("unknown")))
    s = F.when(ok, F.coalesce(F.col("severity"), F.lit("unknown")))
    g = (splits.select("split", t.alias("t"), s.alias("s"))
         .groupingSets([["split"], ["split", "t"], ["split", "s"]], "split", "t", "s")
         .agg(F.count("*").alias("n"), F.grouping_id().alias("gid")))
    dim = (F.when(F.col("gid") == 3, F.lit("total")).when(F.col("gid") == 1, F.lit("ticket_type"))
           .otherwise(F.lit("severity")))
    value = F.when(F.col("gid") == 1, F.col("t")).when(F.col("gid") == 2, F.col("s"))
    out = g.select("split", dim.alias("dim"), value.alias("value"), "n")
    return out.where((F.col("dim") == "total") | F.col("value").isNotNull())
