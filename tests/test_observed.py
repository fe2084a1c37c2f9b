"""Counts taken while writing are those of a scan, and count a retried task once."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from panelkit.operators import missing as M
from panelkit.operators import rules as R
from panelkit.operators.observed import PanelObservation
from panelkit.plans import queries as Q
from panelkit.plans.survey import RAW_COLUMNS, RULE_NAMES

from .conftest import SMALL

RULES = ["r1", "r2", "r3"]


def panel(spark, n=4000):
    i = F.col("id")
    return spark.range(0, n, 1, 7).select(
        F.when(i % 11 == 0, None).otherwise(F.concat(F.lit("20"), (i % 5).cast("string"))).alias("period"),
        F.when(i % 3 == 0, None).otherwise(i).alias("a"), F.when(i % 10 != 0, i).alias("b"), F.lit(None).cast("string").alias("c"),
        F.when(i % 4 == 0, "r1").when(i % 7 == 0, "r3").alias("exclusion_reason"))


def watched(spark, df, folder):
    seen = PanelObservation(["a", "b", "c"], RULES)
    seen.attach(df.select("*", seen.null_bits())).write.parquet(f"{folder}/out")
    return seen


def rows(df):
    return sorted(map(repr, df.collect()))


def test_counts_are_the_scans(spark, tmpdir_path):
    df = panel(spark)
    seen = watched(spark, df, tmpdir_path)
    assert rows(seen.counts(spark)) == rows(df.groupBy("period", "exclusion_reason").agg(F.count(F.lit(1)).alias("n")))
    assert rows(seen.missing_table(spark, "x")) == rows(M.missing_table(df, ["a", "b", "c"], "x"))
    assert rows(seen.rows_by(spark)) == rows(df.groupBy("period").agg(F.count(F.lit(1)).alias("rows")))
    named = df.where("period IS NOT NULL")
    counts = seen.counts(spark).where("period IS NOT NULL")
    assert rows(R.exclusion_cascade(counts, RULES, weight="n")) == rows(R.exclusion_cascade(named, RULES))
    assert rows(R.reason_counts_long(counts, RULES, weight="n")) == rows(R.reason_counts_long(named, RULES))
    assert spark.read.parquet(f"{tmpdir_path}/out").columns == df.columns


def test_empty_panel(spark, tmpdir_path):
    seen = watched(spark, panel(spark, 0), tmpdir_path)
    assert seen.counts(spark).count() == 0
    assert [(r["missing"], r["pct"]) for r in seen.missing_table(spark).collect()] == [(0, None)] * 3


def test_too_many_pairs_or_columns_raise(spark, tmpdir_path):
    df = spark.range(5000).select(F.col("id").cast("string").alias("period"), F.lit(1).alias("a"), F.lit(1).alias("b"), F.lit(1).alias("c"),
                                  F.lit(None).cast("string").alias("exclusion_reason"))
    seen = watched(spark, df, tmpdir_path)
    with pytest.raises(ValueError):
        seen.counts(spark)
    with pytest.raises(ValueError):
        PanelObservation([f"c{i}" for i in range(63)], RULES)


def test_prepared_panel_is_counted_as_it_is_written(spark):
    seen = Q.observed(spark, SMALL)
    scan = Q.marked(spark, SMALL).groupBy("period", "exclusion_reason").agg(F.count(F.lit(1)).alias("n"))
    assert rows(seen.counts(spark)) == rows(scan)
    assert rows(seen.missing_table(spark, "all")) == rows(M.missing_table(Q.raw_store(spark, SMALL), list(RAW_COLUMNS), "all"))
    assert len(RULE_NAMES) + 1 >= scan.select("exclusion_reason").distinct().count()


def test_retried_tasks_count_once(tmpdir_path):
    """Every writing task fails at its first attempt, after its rows were counted."""
    script = textwrap.dedent(f"""
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from tests.test_observed import panel, RULES
        from panelkit.operators.observed import PanelObservation
        spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        seen = PanelObservation(["a", "b", "c"], RULES)
        def once(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("first attempt")
        df = panel(spark).repartition(4)
        out = seen.attach(df.select("*", seen.null_bits()))
        out.mapInArrow(once, out.schema).write.parquet("{tmpdir_path}/out")
        print("RESULT", sum(r["n"] for r in seen.counts(spark).collect()), spark.read.parquet("{tmpdir_path}/out").count())
    """)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", script], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert "RESULT 4000 4000" in got.stdout, got.stderr[-2000:]
