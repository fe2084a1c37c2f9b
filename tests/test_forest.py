"""A forest grown in parts: all its trees, over all rows, with less kept at a time."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from panelkit.ml import forest as FO
from panelkit.ml import regress as RG
from panelkit.sources.storage import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(300).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST((id * 37) % 101 AS DOUBLE) AS y")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def _stage(tree_rows, trees=7, depth=3):
    stage = RG.rf_stage("y", trees, depth)
    stage.tree_rows = tree_rows
    return stage


def test_the_trees_of_a_part_are_bounded_by_the_rows(spark):
    stage = RG.rf_stage("y", 120, 10)
    for rows in (0, 1, FO.TREE_ROWS // 120, FO.TREE_ROWS // 120 + 1, 35_000_000, 42_000_000):
        sizes = stage.parts(rows)
        assert sum(sizes) == 120 and max(sizes) * rows <= FO.TREE_ROWS and max(sizes) - min(sizes) <= 1
    assert stage.parts(FO.TREE_ROWS // 120) == [120] and stage.parts(10 * FO.TREE_ROWS) == [1] * 120


def test_node_numbers_are_not_written_to_the_shared_folder(spark):
    stage = RG.rf_stage("y", 5, 4)
    assert stage.getCacheNodeIds() and stage.getCheckpointInterval() == -1


def test_one_part_is_the_plain_forest(rows):
    assert isinstance(_stage(300 * 7).fit(rows), RandomForestRegressionModel)


def test_a_prediction_is_the_mean_over_all_trees(rows):
    whole = _stage(300 * 3).fit(rows)
    assert [part.getNumTrees for part in whole.parts] == [3, 2, 2] and whole.getNumTrees == len(whole.trees) == 7
    assert len({part.getSeed() for part in whole.parts}) == 3
    points = [r["features"] for r in rows.select("features").distinct().collect()]
    got = {tuple(r["features"]): r[RG.PRED] for r in whole.transform(rows).collect()}
    for v in points:
        assert abs(got[tuple(v)] - sum(tree.predict(v) for tree in whole.trees) / 7) < 1e-9
    assert whole.transform(rows).columns == [*rows.columns, RG.PRED]
    assert abs(whole.featureImportances.toArray().sum() - 1) < 1e-9 and whole.featureImportances.toArray().min() >= 0


def test_every_part_sees_all_rows(rows):
    """A tree of depth 0 predicts the mean of its bootstrap sample of all rows, whichever part it is of."""
    lo = rows.agg(F.avg("y")).first()[0]
    for tree in _stage(300, trees=4, depth=0).fit(rows).trees:
        assert abs(tree.predict(rows.first()["features"]) - lo) < 10


def test_a_forest_in_parts_is_saved_and_loaded(rows, tmpdir_path):
    model = PipelineModel([_stage(300 * 3).fit(rows)])
    save_model(model, f"{tmpdir_path}/m")
    again = load_model(f"{tmpdir_path}/m")
    both = again.transform(model.transform(rows).withColumnRenamed(RG.PRED, "first"))
    assert both.where(F.abs(F.col("first") - F.col(RG.PRED)) > 1e-12).count() == 0
    assert again.stages[-1].uid == model.stages[-1].uid


def test_the_grid_and_the_refit_take_forests_in_parts(spark, monkeypatch):
    df = spark.range(200).selectExpr("CAST(id % 17 AS DOUBLE) AS x", "IF(id % 3 = 0, 'p', 'q') AS g", "CAST((id * 37) % 101 AS DOUBLE) AS y")
    plain = RG.rf_stage
    monkeypatch.setattr(RG, "TREE_ROWS", 1)

    def small(*args):
        stage = plain(*args)
        stage.tree_rows = 600
        return stage
    monkeypatch.setattr(RG, "rf_stage", small)
    got = RG.fit_grid(df, df, ["x"], ["g"], "y", "rf", [("one", 3, 2), ("two", 8, 3)])
    assert {r["config"] for r in got.results.collect()} == {"one", "two"} and got.models["two"].getNumTrees == 8
    final = RG.refit(df, ["x"], ["g"], "y", "rf", ("two", 8, 3))
    assert isinstance(final.stages[-1], FO.ForestInParts)
    table = {r["variable"]: r["importance"] for r in RG.importance_table(final, df, None).collect()}
    assert set(table) == {"x", "g_ohe_p", "g_ohe_q"} and abs(sum(table.values()) - 1) < 1e-9
