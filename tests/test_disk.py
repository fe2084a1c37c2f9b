"""What stays on disk: shuffle files of ended steps, columns in a shuffle."""

import os
import time

import pytest
from pyspark.sql import functions as F

from panelkit.operators.joins import cut
from panelkit.session import SHUFFLE_CLEANUP, shuffles_dropped
from panelkit.sources.buckets import write_key_store
from panelkit.sources.storage import write_partitioned


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {os.path.basename(found.apply(i).getPath()) for i in range(found.size())
            if os.path.basename(found.apply(i).getPath()).startswith("shuffle_")}


def _left_by(spark, step):
    before = _shuffle_files(spark)
    kept = step()
    until = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left, kept


def _rows(spark):
    return spark.range(2000, numPartitions=4).select((F.col("id") % 3).cast("string").alias("period"), F.col("id").alias("person"))


@pytest.mark.parametrize("step", ["partitioned", "keys", "cut"])
def test_a_step_leaves_no_shuffle_files(spark, tmpdir_path, step):
    run = {"partitioned": lambda: write_partitioned(_rows(spark), f"{tmpdir_path}/p"),
           "keys": lambda: write_key_store(_rows(spark), ["period", "person"], f"{tmpdir_path}/k", 4),
           "cut": lambda: cut(_rows(spark).groupBy("period").agg(F.count(F.lit(1)).alias("n")))}[step]
    left, kept = _left_by(spark, run)
    assert not left
    if step == "cut":
        assert sorted((r["period"], r["n"]) for r in kept.collect()) == [("0", 667), ("1", 667), ("2", 666)]


def test_the_setting_ends_with_the_block_and_the_sessions_own_is_kept(spark):
    with pytest.raises(RuntimeError), shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise RuntimeError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        with shuffles_dropped(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def test_the_raw_panel_joins_its_widest_side_last(spark, tmpdir_path):
    from panelkit.plans.testpanel import raw_panel
    tables = {"lineitem": "1L AS l_orderkey, 2L AS l_partkey, 3L AS l_suppkey, 1 AS l_linenumber, 5.0D AS l_quantity, 10.5D AS l_extendedprice, 'N' AS l_returnflag",
              "orders": "1L AS o_orderkey, 7L AS o_custkey, 'P' AS o_orderstatus, DATE'1999-05-01' AS o_orderdate, '1-URGENT' AS o_orderpriority",
              "part": "2L AS p_partkey, 6 AS p_size"}
    for name, row in tables.items():
        spark.sql(f"SELECT {row}").write.parquet(f"{tmpdir_path}/{name}.parquet")
    df = raw_panel(spark, tmpdir_path)
    joins = [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in line]
    assert len(joins) == 2 and "o_orderkey" in joins[0] and "p_partkey" in joins[1]
    rows = df.collect()
    assert len(rows) == 2 and rows[0] == rows[1] and (rows[0]["NUM_HOGAR"], rows[0]["P05H01A"], rows[0]["FACTOR"]) == ("1", "24", "7.5")
