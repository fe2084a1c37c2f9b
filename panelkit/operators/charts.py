"""Chart data computed on all rows (C1 C2 C3 C4); drawing is left to the
caller. Every output is an aggregate whose size does not grow with the
input (bins, groups) except the bounded scatter sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.predicates import safe_log10
from panelkit.operators.describe import quantiles
from panelkit.operators.joins import checked_join
from panelkit.operators.ranks import exact_quantiles, rank_table
from panelkit.operators.sampling import hash_sample


def histogram(df: DataFrame, value: str, bins: int = 80, log10: bool = False) -> DataFrame:
    """Equal-width histogram (optionally of log10 of positive
    values): bin, lower, upper, n. The bounds are one bounded aggregate
    brought back as literals; the binning is a projection + aggregate."""
    x = safe_log10(value) if log10 else F.col(value)
    xs = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    lo, hi = xs.agg(F.min("_x"), F.max("_x")).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = xs.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), "n")


def box_stats(df: DataFrame, value: str, by: list[str], exact: bool = True) -> DataFrame:
    """Per group quartiles and whiskers (most extreme points within
    1.5 IQR of the box); outliers are not returned. Quartiles and whiskers
    come from the value counts, so the rows are read once."""
    values = rank_table(df, value, by) if exact else df.select(*by, value).where(F.col(value).isNotNull())
    probs = [0.25, 0.5, 0.75]
    q = exact_quantiles(None, value, probs, by, ranked=values) if exact else quantiles(df, value, probs, by, False)
    q = q.select(*by, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(value)
    boxed = checked_join(values.select(*by, value), q, by, null_safe=True)
    return boxed.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(x >= F.col("q1") - reach, x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("q3") + reach, x)).alias("whisker_high"))


def scatter_points(df: DataFrame, key: list[str], cols: list[str], n: int = 10_000,
                   size_from: str | None = None) -> DataFrame:
    """C4: a deterministic sample of points, optionally with a marker size
    clip(size_from / 6, 1, 30)."""
    pts = hash_sample(df, key, n).select(*key, *cols, *([size_from] if size_from and size_from not in cols else []))
    if size_from:
        pts = pts.withColumn("marker_size", F.least(F.greatest(F.col(size_from) / 6.0, F.lit(1.0)), F.lit(30.0)))
    return pts
