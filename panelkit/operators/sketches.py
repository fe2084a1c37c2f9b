"""Approximate A9 A11 A12 A16 C3 from mergeable quantile sketches.

A KLL sketch for each period and group is a few kilobytes, whatever the rows.
Sketches are stored by period; a new or re-delivered quarter writes its own
and no other, and every quantile of any union of periods or groups comes from
merged sketches, without reading rows again. The rank of an answer is off by at most
``rank_error(k)`` of the rows (99 % confidence, each answer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = 400


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch (a fixed formula of the sketch)."""
    return 2.296 / k ** 0.9021


def sketch_values(df: DataFrame, value: str, by: list[str], k: int = K) -> DataFrame:
    """Rows (by..., n, min, max, sketch) over the non-null values: one aggregate,
    sketches are combined in the tasks. A group without values has no row."""
    x = F.col(value).cast("double")
    fine = df.where(x.isNotNull() & ~F.isnan(x))
    return fine.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"),
                                 F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))


def store_sketches(df: DataFrame, value: str, path: str, period: str = "period", by: list[str] | None = None, k: int = K) -> None:
    """Sketches of the periods in ``df``, which replace those periods' stored ones and touch no others."""
    rows = sketch_values(df, value, [period, *(by or [])], k)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged(sketches: DataFrame, by: list[str] | None = None, k: int = K) -> DataFrame:
    """The sketches of the unions: one for each value of ``by``, in any order of merging."""
    return sketches.groupBy(*(by or [])).agg(F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
                                             F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")).where("n > 0")


def sketched_quantiles(sketches: DataFrame, probs: list[float], by: list[str] | None = None, k: int = K, prefix: str = "q") -> DataFrame:
    """(by..., n, q0, q1, ...) as ``describe.quantiles`` gives them; 0 and 1 are the exact least and largest value."""
    m = merged(sketches, by, k)
    at = [F.col("min") if p <= 0 else F.col("max") if p >= 1 else F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs]
    return m.select(*(by or []), "n", *[q.alias(f"{prefix}{i}") for i, q in enumerate(at)])
