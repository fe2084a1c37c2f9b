"""How many fits of a grid run side by side, and what they keep."""

import threading

import pytest
from pyspark.sql import functions as F

from panelkit.ml import segment as SG
from panelkit.ml import weighted as WT


@pytest.fixture()
def rows(spark):
    return spark.range(240).select((F.col("id") % 3 * 10 + F.col("id") % 7).cast("double").alias("x"),
                                   (F.col("id") % 3 * 5 + F.col("id") % 11).cast("double").alias("y"))


def _counted(monkeypatch):
    """The largest number of fits that ran at a time."""
    plain, lock, now, most = SG.KMeans.fit, threading.Lock(), [0], [0]

    def fit(self, *args):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        try:
            return plain(self, *args)
        finally:
            with lock:
                now[0] -= 1
    monkeypatch.setattr(SG.KMeans, "fit", fit)
    return most


def test_large_sets_are_fitted_one_at_a_time(rows, monkeypatch):
    whole = SG.kmeans_grid(rows, {"A": ["x", "y"]}, [2, 3, 4])
    most = _counted(monkeypatch)
    monkeypatch.setattr(SG, "VECTORS_AT_ONCE", 100)
    got = SG.kmeans_grid(rows, {"A": ["x", "y"]}, [2, 3, 4])
    assert most == [1]
    assert {k: [list(c) for c in m.stages[-1].clusterCenters()] for k, m in got.models.items()} == {
        k: [list(c) for c in m.stages[-1].clusterCenters()] for k, m in whole.models.items()}


def test_fits_iterate_over_blocks_and_leave_nothing_cached(spark, rows):
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    got = SG.kmeans_grid(rows, {"A": ["x", "y"]}, [2, 3])
    assert all(m.stages[-1].getSolver() == "block" for m in got.models.values())
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached


def test_scores_of_a_lone_row_and_of_one_cluster(spark):
    points = spark.createDataFrame([(0.0, 2.0), (1.0, 1.0), (9.0, 1.0)], "x double, _weight double")
    got = WT.grid_scores(points, ["x"], WT.Moments(4.0, [0.0], [1.0]), {1: [[2.5]], 2: [[0.0], [9.0]]})
    assert got[1].silhouette is None and got[1].smallest_pct == 100.0
    # rows at 0, 0, 1 against the one at 9, squared distances; the lone row scores 0
    want = (2 * (1 - 0.5 / 81) + (1 - 1.0 / 64) + 0.0) / 4
    assert abs(got[2].silhouette - want) < 1e-12 and got[2].smallest_pct == 25.0
