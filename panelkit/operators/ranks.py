"""Distributed exact ranks and quantiles.

Spark's exact ``percentile`` aggregate keeps every distinct value of a
group in one buffer, and a global window rank sorts a whole column in one
task. Both break when one group holds a third of the rows. This module
builds the same answers from steps that each task does on a bounded range:

1. value counts per (group, value), combined map-side (the only pass over
   the rows), written once;
2. the counts are range-partitioned by (group, value), into as many ranges as
   there are multiples of ROWS_A_RANGE distinct values, so a partition is a
   bounded run of the global order whatever the group sizes; up to one
   such range there is nothing to cut;
3. a total for each (group, partition), summed up to the offset at which a
   group goes on in a partition (as many rows as groups and partitions);
4. a running count inside each (group, partition).

The result, ``rank_table``, gives for every distinct value how many values
of its group sort below it. Exact quantiles (linear interpolation between
order statistics, as ``percentile`` / ``quantile_cont``) and average ranks
with ties (as used by Spearman) are lookups into it. A null group is a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.joins import checked_join, cut

# Distinct values (or rows) of a range, which one task sorts.
ROWS_A_RANGE = 250_000


def value_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return (df.select(*by, value).where(F.col(value).isNotNull())
            .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")))


def ranges_of(rows: int) -> int:
    """Ranges that follow the rows."""
    return max(1, -(-rows // ROWS_A_RANGE))


def rank_table(df: DataFrame, value: str, by: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Rows (by..., value, _c, below, n): for each distinct value of each group
    its count, the number of smaller values and the group's size. ``parts``
    fixes the number of ranges; else it follows the number of distinct values."""
    by = by or []
    counts = cut(value_counts(df, value, by))
    parts = parts or ranges_of(counts.count())
    if parts == 1:
        group = Window.partitionBy(*by)
        here = group.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return cut(counts.select("*", F.coalesce(F.sum("_c").over(here), F.lit(0)).alias("below"), F.sum("_c").over(group).alias("n")))
    counts = cut(counts.repartitionByRange(parts, *by, value).withColumn("_p", F.spark_partition_id()))
    offsets = _offsets(counts, by, F.sum("_c")).select(*by, "_p", "_start", "n")
    placed = checked_join(counts, offsets, [*by, "_p"], null_safe=True)
    here = Window.partitionBy(*by, "_p").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("below", F.col("_start") + F.coalesce(F.sum("_c").over(here), F.lit(0)))
    return cut(placed.drop("_p", "_start"))


def _offsets(ranged: DataFrame, by: list[str], size: Column, *more: Column) -> DataFrame:
    """Rows (by..., _p, _pc, _start, n, *more): a group's rows in a partition, those before
    and all of the group's; as many rows as groups meet partitions."""
    totals = ranged.groupBy(*by, "_p").agg(size.alias("_pc"), *more)
    group = Window.partitionBy(*by)
    before = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("*", F.coalesce(F.sum("_pc").over(before), F.lit(0)).alias("_start"), F.sum("_pc").over(group).alias("n"))


def rows_ranked(df: DataFrame, row: str, value: str, by: str, parts: int | None = None) -> DataFrame:
    """W6 for rows: (row, by, avg_rank), the average rank of each row's value in its
    group, found where the row lies in the sorted order; no join on the value.

    Rows are dealt to ranges by (group, value, row), so a value that a third of
    the rows share is cut like any other run. Inside a range windows give a row's
    rank and its ties there; only the first and last value of a range can go on in the
    next one, and a table of those (two for each group and range) completes them.
    ``row`` must tell rows apart.
    """
    rows = df.select(row, by, value).where(F.col(value).isNotNull())
    parts = parts or ranges_of(rows.count())
    rows = (rows.withColumn("_p", F.lit(0)) if parts == 1 else
            cut(rows.repartitionByRange(parts, by, value, row).withColumn("_p", F.spark_partition_id())))
    here, ties = Window.partitionBy(by, "_p").orderBy(value), Window.partitionBy(by, "_p", value)
    rows = cut(rows.select("*", (F.rank().over(here) - 1).cast("long").alias("_in"), F.count(F.lit(1)).over(ties).alias("_c")))
    if parts == 1:
        return rows.select(row, by, (F.col("_in") + (F.col("_c") + 1) / F.lit(2.0)).alias("avg_rank"))
    edge = F.struct(F.col(value).alias("x"), F.col("_in").alias("i"), F.col("_c").alias("c"))
    spans = _offsets(rows, [by], F.count(F.lit(1)), F.min(edge).alias("lo"), F.max(edge).alias("hi"))
    spans = cut(spans.select(by, "_p", "_start", "lo", "hi"))
    ends = spans.select(by, "_start", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("e"))
    whole = ends.groupBy(by, F.col("e.x").alias("x")).agg(F.min(F.col("_start") + F.col("e.i")).alias("b"), F.sum("e.c").alias("c"))
    for end in ("lo", "hi"):
        of = whole.select(F.col(by).alias("_g"), F.col("x").alias("_x"), F.struct("b", "c").alias(f"_{end}"))
        spans = spans.join(of, F.col(by).eqNullSafe(F.col("_g")) & (F.col(f"{end}.x") == F.col("_x"))).drop("_g", "_x")
    placed = checked_join(rows, spans, [by, "_p"], null_safe=True)
    own = F.struct((F.col("_start") + F.col("_in")).alias("b"), F.col("_c").alias("c"))
    at = F.when(F.col(value) == F.col("lo.x"), F.col("_lo")).when(F.col(value) == F.col("hi.x"), F.col("_hi")).otherwise(own)
    return placed.select(row, by, at.alias("at")).select(row, by, (F.col("at.b") + (F.col("at.c") + 1) / F.lit(2.0)).alias("avg_rank"))


def moments(ranked: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """n, mean, sample sd, min, max, population skewness per group, from
    the (small) value-count table instead of another pass over the rows."""
    by = by or []
    x, c = F.col(value), F.col("_c")
    first = ranked.groupBy(*by).agg(F.sum(c).alias("n"), (F.sum(x * c) / F.sum(c)).alias("mean"),
                                    F.min(x).alias("min"), F.max(x).alias("max"))
    dev = x - F.col("mean")
    second = (checked_join(ranked.select(*by, value, "_c"), first, by, null_safe=True)
              .groupBy(*by, "n", "mean", "min", "max")
              .agg(F.sum(c * dev * dev).alias("_m2"), F.sum(c * dev * dev * dev).alias("_m3")))
    n = F.col("n").cast("double")
    return second.select(
        *by, "n", "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (n - 1))).alias("sd"),
        "min", "max",
        F.when(F.col("_m2") > 0, F.sqrt(n) * F.col("_m3") / F.pow(F.col("_m2"), 1.5)).alias("skewness"))


def means(ranked: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """The mean per group, from the value counts."""
    c = F.col("_c")
    return ranked.groupBy(*(by or [])).agg((F.sum(F.col(value) * c) / F.sum(c)).alias("mean"))


def exact_quantiles(df: DataFrame | None, value: str, probs: list[float], by: list[str] | None = None,
                    parts: int | None = None, prefix: str = "q", ranked: DataFrame | None = None) -> DataFrame:
    """Exact quantiles per group with linear interpolation:
    pos = p * (n - 1); result = v[floor] + (v[ceil] - v[floor]) * (pos - floor).
    Output: by..., n, and one column per probability named
    ``{prefix}{i}`` in the order given.

    Each distinct value stands for the ranks [below, below + count), so a
    wanted rank is found by a filter on the value's own row: one aggregate
    over the value counts, without any join.
    """
    by = by or []
    ranked = rank_table(df, value, by, parts) if ranked is None else ranked
    x, below, c, n = (F.col(k) for k in (value, "below", "_c", "n"))

    def at(rank):
        return F.max(F.when((rank >= below) & (rank < below + c), x))
    wanted = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (n - 1)
        wanted += [at(F.floor(pos)).alias(f"_lo{i}"), at(F.ceil(pos)).alias(f"_hi{i}")]
    got = ranked.groupBy(*by, "n").agg(*wanted)
    out = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (n - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(f"{prefix}{i}"))
    return got.select(*by, "n", *out)


def average_ranks(df: DataFrame, value: str, by: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """(by..., value, avg_rank) with 1-based average ranks for ties:
    below + (count + 1) / 2."""
    by = by or []
    return rank_table(df, value, by, parts).select(
        *by, value, (F.col("below") + (F.col("_c") + F.lit(1)) / F.lit(2.0)).alias("avg_rank"))

