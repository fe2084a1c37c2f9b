"""Distributed exact quantiles / ranks against brute force, including the
many-range path and a hot group holding most rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from panelkit.operators import describe as D
from panelkit.operators.ranks import average_ranks, exact_quantiles, rows_ranked


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 else rnd.choice(["a", "b"])          # 2/3 of rows in one group
        v = round(rnd.lognormvariate(8, 1), 2) if i % 5 else float(rnd.randint(1, 20))   # ties
        rows.append((g, v))
    return spark.createDataFrame(rows, "g string, v double"), rows


def _brute(values, p):
    return float(np.quantile(np.array(sorted(values)), p, method="linear"))


def test_grouped_quantiles_many_ranges(spark):
    df, rows = _data(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.95, 1.0]
    for parts in (1, 7, 64):
        got = {r["g"]: r for r in exact_quantiles(df, "v", probs, ["g"], parts=parts).collect()}
        for g in ("hot", "a", "b"):
            vals = [v for gg, v in rows if gg == g]
            assert got[g]["n"] == len(vals)
            for i, p in enumerate(probs):
                assert abs(got[g][f"q{i}"] - _brute(vals, p)) <= 1e-9 * max(1.0, abs(_brute(vals, p)))


def test_global_quantile_and_p90_ties(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9]], "v double")
    p90 = D.scalar_quantile(df, "v", 0.9).first()[0]
    assert p90 == 9.0
    assert df.where(F.col("v") >= p90).count() == 3          # >= keeps every tied row


def test_average_ranks_match_brute_force(spark):
    df, rows = _data(spark, 800)
    got = {r["v"]: r["avg_rank"] for r in average_ranks(df, "v", parts=5).collect()}
    vals = sorted(v for _, v in rows)
    for v in set(vals[:50] + vals[-50:]):
        below = sum(1 for x in vals if x < v)
        eq = sum(1 for x in vals if x == v)
        assert got[v] == below + (eq + 1) / 2.0


def test_profile_matches_numpy(spark):
    df, rows = _data(spark, 1500)
    prof = D.numeric_profile(df, ["v"]).first()
    vals = np.array([v for _, v in rows])
    assert prof["n"] == len(vals)
    assert abs(prof["mean"] - vals.mean()) < 1e-6 * vals.mean()
    assert abs(prof["sd"] - vals.std(ddof=1)) < 1e-6 * vals.std()
    m = vals.mean()
    g1 = ((vals - m) ** 3).mean() / ((vals - m) ** 2).mean() ** 1.5
    assert abs(prof["skewness"] - g1) < 1e-6 * abs(g1)
    assert abs(prof["median"] - np.median(vals)) < 1e-9 * np.median(vals)
    approx = D.numeric_profile(df, ["v"], exact=False).first()
    assert approx["n"] == prof["n"]


def test_null_groups_are_groups(spark):
    from panelkit.operators.charts import box_stats
    rows = [("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["n"], r["median"], r["mean"]) for r in D.group_quantiles(df, "g", "v").collect()}
    assert got == {"a": (2, 2.0, 2.0), None: (2, 7.0, 7.0)}
    for parts in (1, 6):
        got = {r["g"]: r["q0"] for r in exact_quantiles(df, "v", [0.5], ["g"], parts=parts).collect()}
        assert got == {"a": 2.0, None: 7.0}
    got = {r["g"]: (r["whisker_low"], r["whisker_high"]) for r in box_stats(df, "v", ["g"]).collect()}
    assert got == {"a": (1.0, 3.0), None: (5.0, 9.0)}
    two = df.withColumn("h", F.lit(None).cast("string"))
    assert {(r["g"], r["h"]): r["n"] for r in box_stats(two, "v", ["g", "h"]).collect()} == {("a", None): 2, (None, None): 2}


def rankdata(values):
    """1-based ranks, ties sharing their mean."""
    v = np.array(values)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


def _ranked(spark, parts):
    rnd = random.Random(11)
    vals = [(i, "v", 7.0 if i % 3 == 0 else float(rnd.randint(1, 40))) for i in range(3000)]     # a third at one value
    vals += [(i, "w", float(rnd.randint(1, 3))) for i in range(500)] + [(0, None, 1.0), (1, None, 1.0), (2, "w", None)]
    df = spark.createDataFrame(vals, "row long, g string, x double").repartition(6)
    got = {(r["row"], r["g"]): r["avg_rank"] for r in rows_ranked(df, "row", "x", "g", parts).collect()}
    return vals, got


def test_rows_get_their_average_ranks_in_place(spark):
    for parts in (1, 2, 13, 60):
        vals, got = _ranked(spark, parts)
        for g in ("v", "w", None):
            own = [(i, x) for i, gg, x in vals if gg == g and x is not None]
            want = rankdata([x for _, x in own])
            assert [got[i, g] for i, _ in own] == list(want), (parts, g)
        assert len(got) == sum(x is not None for _, _, x in vals)


def test_a_hot_value_is_cut_like_any_run(spark):
    """A column with a third of its rows at one value: no range holds much more than its share."""
    df = spark.range(0, 40000, 1, 8).select(F.col("id").alias("row"), F.lit("v").alias("g"),
                                            F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 1000).cast("double").alias("x"))
    ranged = df.repartitionByRange(20, "g", "x", "row").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = sorted(r["count"] for r in ranged.collect())
    assert len(sizes) == 20 and sizes[-1] <= 1.5 * sizes[len(sizes) // 2]


def test_spearman_with_ties_and_hot_values(spark):
    from panelkit.operators.corr import spearman_matrix
    rnd = random.Random(5)
    rows = [(float(rnd.randint(1, 9)), 4.0 if i % 3 else float(i), float(rnd.random())) for i in range(900)]
    df = spark.createDataFrame([*rows, (None, 1.0, 2.0)], "a double, b double, c double")
    want = np.corrcoef([rankdata(c) for c in zip(*rows)])
    for r in spearman_matrix(df, ["a", "b", "c"]).collect():
        i, j = "abc".index(r["var_x"]), "abc".index(r["var_y"])
        assert abs(r["r"] - want[i][j]) < 1e-9
