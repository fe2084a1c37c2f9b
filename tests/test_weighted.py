"""Distinct vectors with counts give what the rows give; the figures of the
fits fail when a coefficient, centre or measure is off by 1 %."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from panelkit.ml import leastsquares as LS
from panelkit.ml import regress as RG
from panelkit.ml import segment as SG
from panelkit.ml import weighted as W
from panelkit.plans import queries as Q

from .conftest import SMALL

COLS = ["age", "hours"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(float(rng.randint(15, 30)), float(rng.choice([20, 40, 48, 60])), rng.random() * 100, rng.choice("abc")) for _ in range(1500)]
    data += [(17.0, 40.0, 5.0, "a")] * 800  # a hot vector
    df = spark.createDataFrame(data, "age double, hours double, y double, g string").repartition(5).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def grid(spark, rows):
    return SG.kmeans_grid(rows, {"A": COLS}, [2, 3, 4])


def test_vectors_stand_for_all_rows(spark, rows):
    points = W.distinct_vectors(rows, COLS)
    m = W.moments(points, COLS)
    exact = rows.agg(F.count(F.lit(1)), F.avg("age"), F.avg("hours"), F.stddev_samp("age"), F.stddev_samp("hours")).first()
    assert points.count() == 64 and (m.n, *m.mean, *m.sd) == pytest.approx(tuple(exact), rel=1e-12)
    sc = W.scaler_of(spark, m, "x", "z")
    assert list(sc.mean) == pytest.approx(m.mean, rel=1e-12) and list(sc.std) == pytest.approx(m.sd, rel=1e-12)


def test_cost_of_given_centres_is_the_same_without_grouping(rows):
    points = W.distinct_vectors(rows, COLS)
    m = W.moments(points, COLS)
    centres = {2: [[-1.0, 0.3], [0.8, -0.2]], 3: [[-1.0, -1.0], [0.0, 0.0], [1.5, 1.0]]}
    a = W.grid_scores(points, COLS, m, centres)
    b = W.grid_scores(rows.withColumn(W.WEIGHT, F.lit(1.0)), COLS, m, centres)
    for k in centres:
        assert a[k].wssse == pytest.approx(b[k].wssse, rel=1e-9)
        assert a[k].silhouette == pytest.approx(b[k].silhouette, rel=1e-9) and a[k].smallest_pct == pytest.approx(b[k].smallest_pct)


def test_grid_scores_are_the_evaluators(rows, grid):
    for r in grid.results.collect():
        pred = grid.models["A", r["k"]].transform(rows)
        assert r["silhouette"] == pytest.approx(SG.silhouette(pred), abs=1e-9)
        assert r["wssse"] == pytest.approx(grid.models["A", r["k"]].stages[-1].summary.trainingCost, rel=1e-3)
        sizes = [x["count"] for x in pred.groupBy("cluster").count().collect()]
        assert r["smallest_pct"] == pytest.approx(100 * min(sizes) / sum(sizes))


def test_silhouette_by_sql_from_a_stored_assignment(rows, grid, tmpdir_path):
    r = grid.results.where("k = 3").first()
    pred = SG.assign_clusters(grid.models["A", 3], rows)
    m = grid.moments["A"]
    pred.select(*[x.alias(f"z{j}") for j, x in enumerate(m.scaled(COLS))], "cluster").coalesce(1).write.parquet(f"{tmpdir_path}/a")
    got = duckdb.sql(f"""
        WITH t AS (SELECT *, row_number() OVER () AS rid FROM '{tmpdir_path}/a/*.parquet'),
        s AS (SELECT cluster, count(*) AS n, avg(z0) AS m0, avg(z1) AS m1, avg(z0 * z0 + z1 * z1) AS sq FROM t GROUP BY cluster),
        d AS (SELECT rid, t.cluster AS own, s.cluster AS c, s.n, z0 * z0 + z1 * z1 + s.sq - 2 * (z0 * m0 + z1 * m1) AS d FROM t CROSS JOIN s),
        ab AS (SELECT rid, max(CASE WHEN c = own THEN d * n / (n - 1) END) AS a, min(CASE WHEN c <> own THEN d END) AS b FROM d GROUP BY rid)
        SELECT avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) FROM ab""").fetchall()[0][0]
    assert r["silhouette"] == pytest.approx(got, abs=1e-9)


def test_constant_column_single_rows_and_one_cluster(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (9.0, 5.0)], "age double, hours double")
    points = W.distinct_vectors(df, COLS)
    m = W.moments(points, COLS)
    got = W.grid_scores(points, COLS, m, {1: [[0.0, 0.0]], 2: [[-0.6, 0.0], [1.1, 0.0]]})
    assert got[1].silhouette is None and got[2].smallest_pct == pytest.approx(100 / 3)
    assert 0 < got[2].silhouette < 2 / 3  # the lone row counts 0
    with pytest.raises(ValueError):
        W.moments(W.distinct_vectors(df.limit(0), COLS), COLS)


@pytest.fixture(scope="module")
def regression(rows):
    feats = Pipeline(stages=RG.encoder_stages(["g"]) + [RG.assembler(COLS, ["g"])]).fit(rows)
    return feats, feats.transform(rows)


def test_gram_is_the_matrix_product(regression):
    feats, encoded = regression
    got = {(r["i"], r["j"]): r["value"] for r in LS.gram(encoded, "y", 5).collect()}
    a = np.array([[*r["features"].toArray(), 1.0, r["y"]] for r in encoded.collect()])
    want = a.T @ a
    assert set(got) == {(i, j) for i in range(7) for j in range(i, 7) if want[i, j] != 0}
    assert all(v == pytest.approx(want[k], rel=1e-9) for k, v in got.items())


def test_every_configuration_is_optimal_and_one_per_cent_off_is_not(regression):
    feats, encoded = regression
    stats = LS.LeastSquares.of(encoded, "y", 5)
    for name, reg, en in [*RG.LR_CONFIGS, ("elastic", 1.0, 0.5)]:
        m = RG.lr_stage("y", reg, en).fit(encoded)
        beta = m.coefficients.toArray()
        assert stats.violations(beta, m.intercept, reg, en).max() < 1e-5, name
        assert stats.mse(beta, m.intercept) == pytest.approx(m.summary.meanSquaredError, rel=1e-9)
        if en == 0:
            own, at = stats.solve(reg)
            assert stats.violations(own, at, reg).max() < 1e-12 and stats.mse(own, at) == pytest.approx(m.summary.meanSquaredError, rel=1e-6)
        if np.abs(beta).max() > 1e-3:
            off = beta.copy()
            off[np.argmax(np.abs(beta) * stats.sd)] *= 1.01
            assert stats.violations(off, m.intercept, reg, en).max() > 1e-5


def test_optimality_table(rows, regression):
    feats, encoded = regression
    m = RG.lr_stage("y", 0.3, 0.0).fit(encoded)
    table = RG.optimality(rows, "y", feats, m, 0.3, 0.0).collect()
    assert [r["variable"] for r in table] == ["age", "hours", "g_ohe_a", "g_ohe_b", "g_ohe_c", "(intercept)"] or len(table) == 6
    assert max(r["violation"] for r in table) < 1e-9
    pred = m.transform(encoded)
    values = {r["variable"]: r["coefficient"] for r in table}
    gap = pred.select(F.max(F.abs(F.col(RG.PRED) - RG.from_table(pred, values, COLS, ["g"])))).first()[0]
    assert gap < 1e-9


def test_a_centre_or_a_cost_one_per_cent_off_turns_the_grid_red(spark, monkeypatch):
    good = Q.QUERIES["M7_kmeans_grid"](spark, SMALL).collect()
    assert all(r["centres_are_means"] and r["wssse_is_cost"] and r["smallest_is_share"] for r in good)
    grid_, scans = Q._km_grid(spark, SMALL), Q._grid_moments(spark, SMALL)
    moved = {k: ([[x * 1.01 for x in c] for c in centres], rows_) for k, (centres, rows_) in scans.items()}
    monkeypatch.setattr(Q, "_grid_moments", lambda *a: moved)
    assert not all(r["centres_are_means"] for r in Q.QUERIES["M7_kmeans_grid"](spark, SMALL).collect())
    monkeypatch.setattr(Q, "_grid_moments", lambda *a: scans)
    for column, name, flag in (("wssse", "M7_kmeans_grid", "wssse_is_cost"), ("silhouette", "M8_silhouette_grid", "agrees")):
        off = SG.GridResult(grid_.results.withColumn(column, F.col(column) * 1.01), grid_.models, grid_.points, grid_.moments)
        monkeypatch.setattr(Q, "_km_grid", lambda *a, off=off: off)
        assert not any(r[flag] for r in Q.QUERIES[name](spark, SMALL).collect())


def test_a_metric_one_per_cent_off_changes_the_implied_deviation(spark):
    row = spark.createDataFrame([(100.0, 0.2)], "rmse double, r2 double")
    value = row.select(Q._implied_sd()).first()[0]
    assert value != row.withColumn("rmse", F.col("rmse") * 1.01).select(Q._implied_sd()).first()[0]
    assert value != row.withColumn("r2", F.col("r2") * 1.01).select(Q._implied_sd()).first()[0]
