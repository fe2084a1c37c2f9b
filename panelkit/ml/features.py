"""Feature stages (M4 M5 M13 M14 M21): index, one-hot, assemble, scale.

All stages are Spark ML estimators/transformers: the indexer's label
counts are one distributed aggregation, the encoder and assembler are
projections, the scaler is one summary aggregation.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def encoder_stages(cats: list[str], handle_invalid: str = "keep", drop_reference_level: bool = False):
    """M13 + M14: StringIndexer (labels by descending frequency, ties
    alphabetical; unseen -> extra index) and OneHotEncoder (last slot
    dropped, so an unseen level encodes as all zeros).

    With ``handle_invalid="keep"`` the dropped slot is the unseen level, so
    every real level keeps a slot and each block sums to one (collinear
    with an intercept). ``drop_reference_level=True`` indexes with
    ``error`` instead, dropping the least frequent real level.
    """
    invalid = "error" if drop_reference_level else handle_invalid
    idx = StringIndexer(inputCols=cats, outputCols=[f"{c}_idx" for c in cats], handleInvalid=invalid,
                        stringOrderType="frequencyDesc")
    # The encoder keeps its default ("error"): with a "keep" indexer the
    # unseen index is the last category, which dropLast removes.
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_ohe" for c in cats],
                        dropLast=True)
    return [idx, ohe]


def assembler(num: list[str], cats: list[str], out: str = "features") -> VectorAssembler:
    """M4: numeric columns then one-hot blocks into one vector (nulls are
    an error, as by default)."""
    return VectorAssembler(inputCols=num + [f"{c}_ohe" for c in cats], outputCol=out, handleInvalid="error")


def feature_pipeline(num: list[str], cats: list[str], out: str = "features", **kw) -> Pipeline:
    return Pipeline(stages=encoder_stages(cats, **kw) + [assembler(num, cats, out)])


def scaler(inp: str = "x", out: str = "features") -> StandardScaler:
    """M5: (x - mean) / sample sd."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def feature_names(model: PipelineModel) -> list[str]:
    """Slot names of the assembled vector, in slot order, read off the
    fitted stages: the assembler's inputs, where an encoded column stands for
    the labels its encoder keeps."""
    labels: dict[str, list[str]] = {}
    blocks: dict[str, list[str]] = {}
    inputs: list[str] = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            unseen = ["__unknown"] if stage.getHandleInvalid() == "keep" else []
            labels |= {out: [*own, *unseen] for out, own in zip(stage.getOutputCols(), stage.labelsArray)}
        elif isinstance(stage, OneHotEncoderModel):
            last = -1 if stage.getDropLast() else None
            blocks |= {out: [f"{out}_{x}" for x in labels[src][:last]] for src, out in zip(stage.getInputCols(), stage.getOutputCols())}
        elif isinstance(stage, VectorAssembler):
            inputs = stage.getInputCols()
    return [name for c in inputs for name in blocks.get(c, [c])]


def feature_names_frame(model: PipelineModel, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(feature_names(model))), "idx int, name string")


def vector_columns(df: DataFrame, col: str, names: list[str]) -> DataFrame:
    """Vector -> one double column per slot (for display or SQL checks)."""
    arr = vector_to_array(F.col(col))
    return df.withColumns({n: arr[i] for i, n in enumerate(names)})
