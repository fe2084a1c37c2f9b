"""Correlation matrices as long frames.

Pearson: one aggregation with a ``corr`` per pair (partial+final, k^2
tiny buffers). Spearman: Pearson on average ranks with ties; ranks come
from range partitions (no global sort in one task) and come back by a row
number, so no join meets a hot value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.joins import cut
from panelkit.operators.ranks import rows_ranked


def _complete(df: DataFrame, cols: list[str]) -> DataFrame:
    cond = None
    for c in cols:
        x = F.col(c).isNotNull()
        cond = x if cond is None else cond & x
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).where(cond)


def pearson_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """M1: (var_x, var_y, r) for every ordered pair over complete rows,
    diagonal = 1."""
    d = _complete(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = d.agg(*[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    entries = [f"'{c}', '{c}', CAST(1.0 AS DOUBLE)" for c in cols]
    for i, (a, b) in enumerate(pairs):
        entries += [f"'{a}', '{b}', _r{i}", f"'{b}', '{a}', _r{i}"]
    return row.select(F.expr(f"stack({len(entries)}, {', '.join(entries)}) as (var_x, var_y, r)"))


def rank_columns(df: DataFrame, cols: list[str], parts: int | None = None) -> DataFrame:
    """Replace each column by its average rank (ties share the mean
    rank), computed over complete rows. A row keeps its number through the
    ranking of all columns and gets its ranks back by it."""
    rows = cut(_complete(df, cols)).withColumn("_row", F.monotonically_increasing_id())
    ranked = rows_ranked(rows.unpivot(["_row"], cols, "_v", "_x"), "_row", "_x", "_v", parts)
    return ranked.groupBy("_row").agg(*[F.max(F.when(F.col("_v") == c, F.col("avg_rank"))).alias(c) for c in cols]).drop("_row")


def spearman_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """M2: Spearman correlation = Pearson on average ranks."""
    return pearson_matrix(rank_columns(df, cols), cols)


def correlation_ranking(matrix: DataFrame, target: str, n: int | None = None) -> DataFrame:
    """M3 + T3: correlations of the other variables with ``target``,
    ordered by absolute value (ties by name)."""
    out = (matrix.where((F.col("var_x") == target) & (F.col("var_y") != target))
           .select(F.col("var_y").alias("variable"), "r")
           .orderBy(F.desc(F.abs("r")), "variable"))
    return out.limit(n) if n else out

