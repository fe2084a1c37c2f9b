"""Ingest of per-period files, load summary and Parquet / model round trips."""

import os

import pytest
from pyspark.sql import functions as F

from panelkit.plans.survey import RAW_COLUMNS
from panelkit.plans.testpanel import raw_panel
from panelkit.sources import ingest as I
from panelkit.sources import storage as S

from .conftest import SMALL


def _write_sources(spark, base):
    raw = raw_panel(spark, SMALL)
    srcs = []
    for i, (period, extra) in enumerate([("1995Q1", False), ("1995Q2", True)]):
        part = raw.where(F.col("period") == period).drop("source", "period", "period_year", "period_quarter")
        cols = [F.col(c).alias(f" {c.lower()} ") for c in part.columns if c != "TRIMESTRE"]
        if extra:
            cols.append(F.lit("x").alias("NEW_COLUMN"))
        path = os.path.join(base, f"file_{i}.csv")
        part.select(*cols).write.mode("overwrite").option("header", "true").csv(path)
        srcs.append(I.Source(period, int(period[:4]), int(period[-1]), "develop", path))
    return srcs


def test_ingest_manifest(spark, tmpdir_path):
    srcs = _write_sources(spark, tmpdir_path)
    dest = os.path.join(tmpdir_path, "raw")
    summary = {r["period"]: r for r in I.ingest_manifest(spark, srcs, RAW_COLUMNS, dest, "csv").collect()}
    assert summary["1995Q1"]["missing_required"] == "TRIMESTRE"
    assert summary["1995Q2"]["source_columns"] == summary["1995Q1"]["source_columns"] + 1
    frames = I.read_periods(spark, dest, ["1995Q1", "1995Q2"])
    for p, df in frames.items():
        assert df.count() == summary[p]["rows"]
        assert df.columns[:len(RAW_COLUMNS)] == RAW_COLUMNS
        assert df.where(F.col("TRIMESTRE").isNotNull()).count() == 0
        assert df.select(F.countDistinct("period")).first()[0] == 1


def test_manifest_missing_file(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        I.check_manifest(spark, [I.Source("X", 2000, 1, "test", os.path.join(tmpdir_path, "nope.csv"))])


def test_header_collision(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `A ` int")
    with pytest.raises(ValueError):
        I.normalise_headers(df)


def test_partitioned_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("2025T1", 1, 2.0), ("2025T2", 2, 3.0), ("2025T1", 3, 4.0)], "period string, id int, v double")
    path = os.path.join(tmpdir_path, "part")
    S.write_partitioned(df, path, "period")
    back = S.read_parquet(spark, path)
    assert back.columns[-1] == "period"
    assert sorted(back.collect()) == sorted([(1, 2.0, "2025T1"), (2, 3.0, "2025T2"), (3, 4.0, "2025T1")])
    assert back.where(F.col("period") == "2025T1").count() == 2


def test_model_roundtrip(spark, tmpdir_path):
    from panelkit.ml import regress as RG
    df = spark.createDataFrame([(1.0, "a", 2.0), (2.0, "b", 4.1), (3.0, "a", 6.2)], "x double, c string, y double")
    m = RG.full_pipeline(["x"], ["c"], RG.lr_stage("y", 0.0, 0.0)).fit(df)
    path = os.path.join(tmpdir_path, "model")
    S.save_model(m, path)
    again = S.load_model(path)
    a = [r[0] for r in m.transform(df).select(RG.PRED).collect()]
    b = [r[0] for r in again.transform(df).select(RG.PRED).collect()]
    assert a == b


def test_hot_period_tasks_follow_its_rows(spark, tmpdir_path):
    """The number of tasks that write the hot period grows with its rows."""
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    files = []
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        for n in (8000, 32000):
            df = spark.range(n, numPartitions=n // 1000).select(  # a scan has as many tasks as its size asks for
                F.when(F.col("id") % 10 > 0, "HOT").otherwise("COLD").alias("period"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
            path = os.path.join(tmpdir_path, f"hot{n}")
            S.write_partitioned(df, path, "period")
            files.append(len([f for f in os.listdir(os.path.join(path, "period=HOT")) if f.endswith(".parquet")]))
            assert S.read_parquet(spark, path).count() == n
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert 1 < files[0] < files[1]


def test_typed_numbers_keep_their_digits(spark):
    from panelkit.sources.ingest import ingest_frame
    df = spark.sql("SELECT 9007199254740993L AS a, 9223372036854775807L AS b, 1e20D AS c, CAST(12.50 AS DECIMAL(10,2)) AS d, "
                   "'9007199254740993.0' AS e, '1e20' AS f, CAST(7 AS DECIMAL(38,0)) AS g, -0.0D AS h, '+007' AS i")
    assert tuple(ingest_frame(df, list("ABCDEFGHI"), {}).first()) == (
        "9007199254740993", "9223372036854775807", "100000000000000000000", "12.5", "9007199254740993", "100000000000000000000", "7", "0", "7")


def test_splits_prune_by_the_partition_column(spark, tmpdir_path):
    from panelkit.plans.queries import years
    path = os.path.join(tmpdir_path, "p")
    S.write_partitioned(spark.createDataFrame([(f"{y}T{q}", y) for y in (1999, 2000, 2001) for q in (1, 4)], "period string, y int"), path)
    back = S.read_parquet(spark, path)
    for cond, want in ((years(last=1999), {1999}), (years(2000, 2000), {2000}), (years(last=2000), {1999, 2000}), (years(2001), {2001})):
        kept = back.where(cond)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(period" in plan and "DataFilters: []" in plan
        assert {r["y"] for r in kept.collect()} == want


def test_wide_side_takes_a_shuffle_join(spark):
    from panelkit.operators.joins import checked_join
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    narrow = checked_join(left, right, "k", max_broadcast_bytes=1 << 20)._jdf.queryExecution().sparkPlan().toString()
    wide = checked_join(left, right, "k", max_broadcast_bytes=50_000)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in narrow and "SortMergeJoin" in wide and "Broadcast" not in wide


def test_shares_count_unlisted_categories(spark):
    from panelkit.ml.segment import composition_wide
    df = spark.createDataFrame([(0, "x"), (0, "y"), (0, "z"), (0, None)], "cluster int, c string")
    assert tuple(composition_wide(df, "cluster", "c", ["x", "y"]).first()) == (0, 25.0, 25.0, 50.0)


def test_checkpoint_folder_is_required_on_a_cluster():
    from panelkit.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://x:1"})()
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_missing_table_empty_and_counts(spark):
    from panelkit.operators import missing as M
    empty = spark.createDataFrame([], "a string, b string")
    rows = {r["variable"]: r for r in M.missing_table(empty, ["a", "b"], "x").collect()}
    assert rows["a"]["missing_x"] == 0 and rows["a"]["pct_x"] is None
    df = spark.createDataFrame([("1", None), (None, None), ("3", "z"), ("4", None)], "a string, b string")
    rows = {r["variable"]: r for r in M.missing_table(df, ["a", "b"], "x").collect()}
    assert (rows["a"]["missing_x"], rows["a"]["pct_x"]) == (1, 25.0)
    assert (rows["b"]["missing_x"], rows["b"]["pct_x"]) == (3, 75.0)
