"""Regression metrics (A19 R6) in one aggregation pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str, name: str | None = None) -> DataFrame:
    """N, MAE, RMSE and R^2 = 1 - SSE / SST in one pass (SST from the
    population variance of the label over the evaluated rows, as the
    evaluator does)."""
    err = F.col(label) - F.col(prediction)
    out = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(label) * F.count(F.lit(1)))).alias("r2"),
    )
    return out.select(F.lit(name).cast("string").alias("model"), "*") if name is not None else out


def stack_metrics(frames: list[DataFrame]) -> DataFrame:
    """Stack one-row metric frames (by column name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def metrics_long(df: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """A19 for several prediction columns of the same rows at once:
    (model, n, mae, rmse, r2), one scan."""
    aggs = [F.count(F.lit(1)).alias("n"), F.var_pop(label).alias("_var")]
    for i, (_, p) in enumerate(predictions.items()):
        e = F.col(label) - F.col(p)
        aggs += [F.avg(F.abs(e)).alias(f"_mae{i}"), F.avg(e * e).alias(f"_mse{i}"), F.sum(e * e).alias(f"_sse{i}")]
    row = df.agg(*aggs)
    parts = ", ".join(f"'{m}', _mae{i}, _mse{i}, _sse{i}" for i, m in enumerate(predictions))
    long = row.select("n", "_var", F.expr(f"stack({len(predictions)}, {parts}) as (model, mae, _mse, _sse)"))
    return long.select("model", "n", "mae", F.sqrt("_mse").alias("rmse"),
                       (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n"))).alias("r2"))


def best_by(df: DataFrame, metric: str = "rmse", name: str = "model") -> DataFrame:
    """The row with the smallest metric (ties by name)."""
    return df.orderBy(F.asc(metric), F.asc(name)).limit(1)
