"""K choice hand tables, KMeans and regression invariants."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from panelkit.ml import features as FE
from panelkit.ml import regress as RG
from panelkit.ml import segment as SG
from panelkit.operators import metrics as MT

GRID = "option string, k int, silhouette double, wssse double, smallest_pct double"


def test_choose_k_elbow(spark):
    rows = [("A", 2, .55, 100.0, 40.0), ("A", 3, .44, 79.0, 20.0), ("A", 4, .47, 60.0, 12.9), ("A", 5, .44, 57.6, 5.0)]
    assert SG.chosen_k(spark.createDataFrame(rows, GRID), "A") == 4


def test_choose_k_no_elbow(spark):
    rows = [("A", 2, .45, 100.0, 40.0), ("A", 3, .50, 50.0, 20.0), ("A", 4, .47, 25.0, 12.9), ("A", 5, .30, 12.5, 5.0)]
    assert SG.chosen_k(spark.createDataFrame(rows, GRID), "A") == 3


def test_choose_k_none_valid(spark):
    rows = [("A", 2, .10, 100.0, 40.0), ("A", 3, .20, 50.0, 1.0)]
    with pytest.raises(ValueError):
        SG.chosen_k(spark.createDataFrame(rows, GRID), "A")


def _points(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for c, (x0, y0) in enumerate([(0, 0), (10, 10), (0, 10)]):
        for _ in range(120):
            rows.append((float(x0 + rnd.gauss(0, 1)), float(y0 + rnd.gauss(0, 1)), float(rnd.randint(1, 100))))
    return spark.createDataFrame(rows, "x double, y double, w double")


def test_kmeans_invariants(spark):
    df = _points(spark)
    g = SG.kmeans_grid(df, {"A": ["x", "y"]}, [2, 3])
    res = {r["k"]: r for r in g.results.collect()}
    assert res[3]["silhouette"] > 0.6
    model = g.models[("A", 3)]
    pred = model.transform(df)
    centres = model.stages[-1].clusterCenters()
    own = pred.select("features", "cluster").collect()
    sse = 0.0
    for r in own:
        d = [float(Vectors.squared_distance(r["features"], c)) for c in centres]
        assert d[r["cluster"]] == min(d)
        sse += d[r["cluster"]]
    assert abs(sse - res[3]["wssse"]) <= 1e-6 * sse
    sizes = SG.cluster_sizes(pred).collect()
    assert sum(r["n"] for r in sizes) == df.count()
    cent = SG.centroids(model, ["x", "y"]).collect()
    assert len(cent) == 3


def test_unseen_category_and_feature_layout(spark):
    train = spark.createDataFrame([(1.0, "a", 10.0), (2.0, "a", 12.0), (3.0, "b", 20.0), (4.0, "c", 25.0)],
                                  "x double, cat string, y double")
    test = spark.createDataFrame([(2.5, "zzz", 0.0)], "x double, cat string, y double")
    model = FE.feature_pipeline(["x"], ["cat"]).fit(train)
    names = FE.feature_names(model)
    assert names == ["x", "cat_ohe_a", "cat_ohe_b", "cat_ohe_c"]      # every real level keeps a slot
    v = model.transform(test).select("features").first()[0].toArray()
    assert list(v[1:]) == [0.0, 0.0, 0.0]                              # unseen -> all-zero block
    lr = RG.full_pipeline(["x"], ["cat"], RG.lr_stage("y", 0.0, 0.0)).fit(train)
    assert lr.transform(test).select(RG.PRED).first()[0] is not None


def test_regression_invariants(spark):
    df = _points(spark).withColumn("g", F.when(F.col("x") > 5, "hi").otherwise("lo"))
    lr = RG.full_pipeline(["x", "y"], ["g"], RG.lr_stage("w", 0.0, 0.0)).fit(df)
    res = lr.transform(df).select((F.col("w") - F.col(RG.PRED)).alias("r"))
    assert abs(res.agg(F.avg("r")).first()[0]) < 1e-6
    rf = RG.full_pipeline(["x", "y"], ["g"], RG.rf_stage("w", 10, 4)).fit(df)
    lo, hi = df.agg(F.min("w"), F.max("w")).first()
    plo, phi = rf.transform(df).agg(F.min(RG.PRED), F.max(RG.PRED)).first()
    assert lo <= plo and phi <= hi
    imp = RG.importance_table(rf, df, None).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9 and min(r["importance"] for r in imp) >= 0


def test_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.5), (4.0, 3.0)], "y double, prediction double")
    m = MT.regression_metrics(df, "y", "prediction").first()
    for name in ("mae", "rmse", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=name).evaluate(df)
        assert abs(m[name] - ev) < 1e-12


def test_forest_keeps_its_rows_nodes_and_its_trees(spark):
    """The kept nodes save the walk from the root at every level and change no tree."""
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(400).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST((id * 37) % 101 AS DOUBLE) AS y")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    stage = RG.rf_stage("y", 5, 4)
    assert stage.getCacheNodeIds()
    kept, walked = (s.fit(rows).toDebugString.split("\n", 1)[1] for s in (stage, stage.copy().setCacheNodeIds(False)))
    assert kept == walked
