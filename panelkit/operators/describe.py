"""Descriptive statistics over all rows (A1 A9 A10 A11 A12 A16 E23 E25 W3
T4 J5).

Moments are one partial+final aggregation; quantiles come from
``ranks.exact_quantiles`` (exact, bounded memory) or ``percentile_approx``
(``exact=False``). Several variables are profiled in one pass by
unpivoting to (variable, value) first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.coerce import label_rank
from panelkit.functions.predicates import pct_change, ratio
from panelkit.operators.joins import null_safe_join, total
from panelkit.operators.ranks import exact_quantiles, means, moments, rank_table

PROFILE_PROBS = [0.25, 0.5, 0.75, 0.95]


def unpivot(df: DataFrame, cols: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide numeric columns -> long (variable, value) rows, as double."""
    casted = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot([], cols, name, value)


def quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None,
              exact: bool = True, prefix: str = "q") -> DataFrame:
    """(by..., n, q0..qk). exact=True: distributed exact order statistics;
    exact=False: ``percentile_approx`` sketches (bounded memory)."""
    by = by or []
    if exact:
        return exact_quantiles(df, value, probs, by, prefix=prefix)
    agg = (df.where(F.col(value).isNotNull()).groupBy(*by)
           .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(value, probs, 100_000).alias("_qs")))
    return agg.select(*by, "n", *[F.col("_qs")[i].alias(f"{prefix}{i}") for i in range(len(probs))])


def numeric_profile(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Per variable n, mean, sample sd, min, P25, median, P75, P95,
    max and population skewness (g1). One pass over the rows builds the
    (variable, value, count) table; moments and exact quantiles are
    computed from it."""
    long = unpivot(df, cols)
    if exact:
        rt = rank_table(long, "value", ["variable"])
        mom = moments(rt, "value", ["variable"])
        qs = exact_quantiles(None, "value", PROFILE_PROBS, ["variable"], ranked=rt).drop("n")
    else:
        mom = long.groupBy("variable").agg(
            F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
            F.min("value").alias("min"), F.max("value").alias("max"), F.skewness("value").alias("skewness"))
        qs = quantiles(long, "value", PROFILE_PROBS, ["variable"], exact=False).drop("n")
    out = mom.join(qs, "variable", "left")
    return out.select("variable", "n", "mean", "sd", "min", F.col("q0").alias("p25"), F.col("q1").alias("median"),
                      F.col("q2").alias("p75"), F.col("q3").alias("p95"), "max", "skewness")


def profile_ratios(profile: DataFrame) -> DataFrame:
    """Mean - median gap (absolute and % of the median) and max / median."""
    return profile.select(
        "variable",
        (F.col("mean") - F.col("median")).alias("mean_minus_median"),
        pct_change("mean", "median").alias("mean_over_median_pct"),
        ratio("max", "median").alias("max_over_median"))


def frequencies(df: DataFrame, col: str, order: list[str] | None = None) -> DataFrame:
    """A10 + W3 + T4: count and % of total per category; ordered by count
    (desc, ties by label) or by a given category order (present ones)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    out = counts.withColumn("pct", F.lit(100.0) * F.col("n") / total(counts, F.sum("n")))
    if order:
        return out.withColumn("sort_key", label_rank(col, order)).orderBy("sort_key").drop("sort_key")
    return out.orderBy(F.desc("n"), col)


def group_quantiles(df: DataFrame, by: str | list[str], value: str, exact: bool = True) -> DataFrame:
    """Per group n, median, P25, P75, mean, and the distances
    median - P25 and P75 - median (error-bar lengths)."""
    by = [by] if isinstance(by, str) else by
    probs = [0.5, 0.25, 0.75]
    if exact:
        ranked = rank_table(df, value, by)
        mean, qs = means(ranked, value, by), exact_quantiles(None, value, probs, by, ranked=ranked)
    else:
        mean, qs = df.groupBy(*by).agg(F.avg(value).alias("mean")), quantiles(df, value, probs, by, exact=False)
    out = null_safe_join(qs, mean, by)
    return out.select(*by, "n", F.col("q0").alias("median"), F.col("q1").alias("p25"), F.col("q2").alias("p75"),
                      "mean", (F.col("q0") - F.col("q1")).alias("median_minus_p25"),
                      (F.col("q2") - F.col("q0")).alias("p75_minus_median"))


def per_period(df: DataFrame, value: str, period: str = "period", exact: bool = True) -> DataFrame:
    """Per period n, median, mean, ordered by period."""
    g = group_quantiles(df, period, value, exact)
    return g.select(period, "n", "median", "mean").orderBy(period)


def retained_share(stats: DataFrame, originals: DataFrame, period: str = "period") -> DataFrame:
    """Per-period stats joined with the original row counts, plus the
    % of original rows retained. Both sides have one row per period."""
    return (stats.join(originals.select(period, F.col("original").alias("original_rows")), period, "inner")
            .withColumn("pct_retained", F.lit(100.0) * F.col("n") / F.col("original_rows")))


def scalar_quantile(df: DataFrame, value: str, p: float, exact: bool = True) -> DataFrame:
    """One exact quantile of a column, as a one-row frame."""
    return quantiles(df, value, [p], None, exact).select(F.col("q0").alias(f"p{int(round(p * 100))}"))


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Presentation rounding (HALF_UP) of selected columns."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def share_of_total(count_col: str = "n", within: list[str] | None = None) -> Column:
    """Count / sum(count) over the group (or all rows), in %."""
    w = Window.partitionBy(*(within or []))
    return F.lit(100.0) * F.col(count_col) / F.sum(count_col).over(w)
