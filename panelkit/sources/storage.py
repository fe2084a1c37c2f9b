"""Parquet sinks / sources and model persistence."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from panelkit.session import shuffles_dropped


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite a Parquet directory."""
    df.write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, by: str) -> DataFrame:
    """Rows dealt so that a value of ``by`` meets in few tasks: adaptive
    execution sizes the tasks by bytes (spark.sql.adaptive.
    advisoryPartitionSizeInBytes), splitting a large period over as many tasks
    as it needs and joining small ones."""
    return df.hint("rebalance", by)


def write_partitioned(df: DataFrame, path: str, by: str = "period") -> None:
    """Parquet partitioned by period, in files sized by the data."""
    with shuffles_dropped(df.sparkSession):
        clustered(df, by).write.mode("overwrite").partitionBy(by).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read back; a partition column comes last and is re-inferred
    from the directory names (string for values like '2025T1')."""
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted pipeline, overwriting."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
