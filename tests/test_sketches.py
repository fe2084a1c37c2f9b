"""Quantile sketches: rank error within the bound, any order of merging, periods added alone."""

import os
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import sketches as S

PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


def data(spark, periods=("2000Q1", "2000Q2", "2000Q3"), n=6000):
    rng = random.Random(3)
    rows = [(p, rng.choice(["a", "b", None]) if i % 3 else "hot", rng.lognormvariate(8, 1) if i % 5 else float(rng.randint(1, 5)))
            for p in periods for i in range(n)]
    rows += [(p, "a", None) for p in periods] + [(periods[0], "none", None)]
    return spark.createDataFrame(rows, "period string, g string, x double"), rows


def off(values, answer, p):
    """How far p lies outside the ranks that the answer has among the values."""
    below = sum(v < answer for v in values) / len(values)
    upto = sum(v <= answer for v in values) / len(values)
    return max(0.0, below - p, p - upto)


@pytest.mark.parametrize("k", [100, 400])
def test_rank_error_is_within_the_bound(spark, k):
    df, rows = data(spark)
    got = {r["g"]: r for r in S.sketched_quantiles(S.sketch_values(df.repartition(9), "x", ["period", "g"], k), [0.0, *PROBS, 1.0], ["g"], k).collect()}
    assert set(got) == {"a", "b", "hot", None}
    for g, r in got.items():
        values = [x for _, gg, x in rows if gg == g and x is not None]
        assert r["n"] == len(values) and r["q0"] == min(values) and r["q6"] == max(values)
        assert all(off(values, r[f"q{i + 1}"], p) <= S.rank_error(k) for i, p in enumerate(PROBS))


def test_order_of_merging_stays_within_the_bound(spark):
    df, rows = data(spark)
    values = [x for _, _, x in rows if x is not None]
    parts = S.sketch_values(df, "x", ["period", "g"])
    by_period, by_group = S.merged(parts, ["period"]), S.merged(parts, ["g"])
    for way in (parts, by_period, by_group, by_group.orderBy(F.desc("n")), S.sketch_values(df, "x", [])):
        r = S.sketched_quantiles(way, PROBS).first()
        assert r["n"] == len(values) and all(off(values, r[f"q{i}"], p) <= S.rank_error() for i, p in enumerate(PROBS))


def test_a_new_quarter_adds_its_sketch_and_leaves_the_others(spark, tmpdir_path):
    path = f"{tmpdir_path}/sketches"
    df, rows = data(spark)

    def files():
        return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.startswith("part-")}
    S.store_sketches(df.where("period < '2000Q3'"), "x", path, by=["g"])
    first = files()
    S.store_sketches(df.where("period = '2000Q3'"), "x", path, by=["g"])
    assert first < files()
    S.store_sketches(df.where("period = '2000Q2'"), "x", path, by=["g"])   # delivered again
    assert {f for f in first if "2000Q1" in f} < files() and not {f for f in first if "2000Q2" in f} & files()
    values = [x for _, _, x in rows if x is not None]
    r = S.sketched_quantiles(S.stored_sketches(spark, path), [0.5]).first()
    assert r["n"] == len(values) and off(values, r["q0"], 0.5) <= S.rank_error()


def test_empty(spark):
    df, _ = data(spark, n=5)
    assert S.sketch_values(df.limit(0), "x", ["g"]).count() == 0
    assert S.sketched_quantiles(S.sketch_values(df.limit(0), "x", ["g"]), PROBS, ["g"]).count() == 0
    assert S.sketched_quantiles(S.sketch_values(df.where("x IS NULL"), "x", ["g"]), PROBS).count() == 0
