"""Fitted pipelines have the shape of the study's saved models: stage order,
encoder/assembler settings, model parameters and 18 feature slots
(3 numeric + 8 education + 4 category + 3 domain levels)."""

import itertools

from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegressionModel, RandomForestRegressionModel

from panelkit.ml import regress as RG
from panelkit.ml.features import feature_names
from panelkit.plans.survey import (CATEGORY_LABELS, DOMAIN_LABELS, EDUCATION_LABELS, FEATURE_CATEGORIES,
                                   FEATURE_NUMERIC, TARGET)


def _survey_like(spark):
    rows = []
    for i, (e, c, d) in enumerate(itertools.product(EDUCATION_LABELS.values(), CATEGORY_LABELS.values(),
                                                    DOMAIN_LABELS.values())):
        rows.append((float(20 + i % 40), float(i % 15), float(30 + i % 20), e, c, d, float(1000 + 37 * i)))
    cols = FEATURE_NUMERIC + FEATURE_CATEGORIES + [TARGET]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c in FEATURE_CATEGORIES else 'double'}"
                                                  for c in cols))


def _check_common(model):
    idx, ohe, asm = model.stages[:3]
    assert isinstance(idx, StringIndexerModel) and isinstance(ohe, OneHotEncoderModel)
    assert isinstance(asm, VectorAssembler)
    assert idx.getHandleInvalid() == "keep" and idx.getStringOrderType() == "frequencyDesc"
    assert ohe.getDropLast() is True and ohe.getHandleInvalid() == "error"
    assert asm.getHandleInvalid() == "error"
    assert asm.getInputCols() == FEATURE_NUMERIC + [f"{c}_ohe" for c in FEATURE_CATEGORIES]


def test_linear_pipeline_shape(spark):
    df = _survey_like(spark)
    model = RG.full_pipeline(FEATURE_NUMERIC, FEATURE_CATEGORIES, RG.lr_stage(TARGET, 0.0, 0.0)).fit(df)
    _check_common(model)
    lr = model.stages[-1]
    assert isinstance(lr, LinearRegressionModel)
    assert lr.getStandardization() and lr.getFitIntercept() and lr.getMaxIter() == 100 and lr.getSolver() == "auto"
    assert lr.numFeatures == 18 and len(feature_names(model)) == 18


def test_forest_pipeline_shape(spark):
    df = _survey_like(spark)
    model = RG.full_pipeline(FEATURE_NUMERIC, FEATURE_CATEGORIES, RG.rf_stage(TARGET, 3, 3)).fit(df)
    _check_common(model)
    rf = model.stages[-1]
    assert isinstance(rf, RandomForestRegressionModel)
    assert rf.getImpurity() == "variance" and rf.getMaxBins() == 32 and rf.getSeed() == 42
    assert rf.getFeatureSubsetStrategy() == "auto" and rf.getSubsamplingRate() == 1.0
    assert rf.numFeatures == 18
