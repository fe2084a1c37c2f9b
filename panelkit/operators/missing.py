"""Missing-data audits (A3 A4 E24 J4), one scan each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_indicator(c: str | Column) -> Column:
    """1 when null, else 0."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull().cast("int")


def _counts(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """Rows ``_n`` and missing values ``_m<i>`` of each column, per group: one aggregation."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(null_indicator(c)).alias(f"_m{i}") for i, c in enumerate(cols)])


def _percent(i: int) -> Column:
    return F.try_divide(F.lit(100.0) * F.col(f"_m{i}"), F.col("_n").cast("double"))


def missing_table(df: DataFrame, cols: list[str], tag: str = "") -> DataFrame:
    """A3: missing count and % per column, long form (variable, position,
    missing_<tag>, pct_<tag>). One aggregation pass; an empty input gives
    0 missing and null %."""
    suffix = f"_{tag}" if tag else ""
    each = [F.struct(F.lit(c).alias("variable"), F.lit(i).alias("position"),
                     F.coalesce(F.col(f"_m{i}"), F.lit(0)).cast("long").alias(f"missing{suffix}"),
                     _percent(i).alias(f"pct{suffix}")) for i, c in enumerate(cols)]
    return _counts(df, cols, []).select(F.inline(F.array(*each)))


def missing_compare(a: DataFrame, b: DataFrame, cols: list[str], tag_a: str, tag_b: str) -> DataFrame:
    """Two missing tables side by side, joined on the variable name
    (both sides have len(cols) rows)."""
    ta = missing_table(a, cols, tag_a)
    tb = missing_table(b, cols, tag_b).drop("position")
    return ta.join(F.broadcast(tb), "variable", "inner")


def missing_by_flag(df: DataFrame, flag: Column, cols: dict[str, str], flag_name: str = "should_answer",
                    digits: int | None = None) -> DataFrame:
    """A4: % null of each column by a population flag (null flag -> false),
    to tell structural absence from non-response."""
    flagged = df.withColumn(flag_name, F.when(flag, True).otherwise(False))
    shares = [_percent(i) if digits is None else F.round(_percent(i), digits) for i in range(len(cols))]
    named = [p.alias(f"pct_null_{name}") for p, name in zip(shares, cols.values())]
    return _counts(flagged, list(cols), [flag_name]).select(flag_name, F.col("_n").alias("rows"), *named)
