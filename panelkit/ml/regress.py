"""Regression under a leakage-free temporal protocol (E16 E17 A15 M15-M24
W5 S11).

Protocol (M20): every stage - encoders included - is fitted only on the
training rows of its step; configurations are compared on the validation
period; the chosen one is refitted on all development rows and scored
once on the later test period. During the grid the encoders are fitted
once per training set and the encoded frame is cached for all configs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.ml.features import assembler, encoder_stages, feature_names
from panelkit.ml.forest import TREE_ROWS, ForestRegressor
from panelkit.ml.leastsquares import LeastSquares
from panelkit.operators.metrics import metrics_long, regression_metrics

SEED = 42
PRED = "prediction"

# Fixed values, the study's configurations: (name, regParam, elasticNetParam) and
# (name, numTrees, maxDepth).
LR_CONFIGS = [("no_reg", 0.0, 0.0), ("ridge_light", 0.3, 0.0), ("ridge_strong", 50.0, 0.0), ("lasso_strong", 50.0, 1.0)]
RF_CONFIGS = [("rf_small", 40, 5), ("rf_medium", 80, 8), ("rf_large", 120, 10)]


@dataclass(frozen=True)
class TemporalSplit:
    """Row filters for each stage of the protocol. On the partition
    column they prune the scan."""

    train: Column
    validate: Column
    develop: Column
    test: Column

    def frames(self, df: DataFrame) -> dict[str, DataFrame]:
        return {k: df.where(getattr(self, k)) for k in ("train", "validate", "develop", "test")}


def lr_stage(label: str, reg: float, en: float) -> LinearRegression:
    """Elastic-net linear regression, internal standardisation."""
    return LinearRegression(featuresCol="features", labelCol=label, predictionCol=PRED, regParam=reg,
                            elasticNetParam=en, standardization=True, maxIter=100, solver="auto")


def rf_stage(label: str, trees: int, depth: int, seed: int = SEED) -> ForestRegressor:
    """Random forest (variance impurity, 32 bins, auto subset). A row's node in
    each tree is kept from level to level, so no level walks every tree from its root again;
    kept by Spark's cache, not checkpointed to the shared folder."""
    return ForestRegressor(featuresCol="features", labelCol=label, predictionCol=PRED, numTrees=trees,
                           maxDepth=depth, seed=seed, maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=-1)


def full_pipeline(num: list[str], cats: list[str], model_stage) -> Pipeline:
    return Pipeline(stages=encoder_stages(cats) + [assembler(num, cats), model_stage])


def mean_baseline(train: DataFrame, target: DataFrame, label: str, out: str = PRED) -> DataFrame:
    """M15 + A15 + E17: predict the training mean for every row. The mean
    is one aggregate; it enters the plan as a literal."""
    mean = train.agg(F.avg(label)).first()[0]
    return target.withColumn(out, F.lit(mean).cast("double"))


def group_mean_predictor(train: DataFrame, target: DataFrame, group: str, label: str, out: str = PRED) -> DataFrame:
    """A deterministic, SQL-checkable predictor: the training mean of the
    label within the row's group (overall training mean for unseen
    groups). The group table has one row per level - a bounded broadcast."""
    from panelkit.operators.joins import checked_join
    overall = train.agg(F.avg(label)).first()[0]
    means = train.groupBy(group).agg(F.avg(label).alias("_gm"))
    j = checked_join(target, means, group, "left", null_safe=True)
    return j.withColumn(out, F.coalesce(F.col("_gm"), F.lit(overall)).cast("double")).drop("_gm")


@dataclass
class GridOutcome:
    results: DataFrame                   # config, params..., n, mae, rmse, r2
    best: str
    features: PipelineModel              # encoders and assembler of the training rows
    models: dict[str, object]            # fitted model of each configuration


def fit_grid(train: DataFrame, valid: DataFrame, num: list[str], cats: list[str], label: str,
             kind: str = "lr", configs=None, parallelism: int = 3) -> GridOutcome:
    """Fit each configuration on the training rows (encoders
    fitted once, encoded rows cached, ``parallelism`` fits at a time) and
    score it on the validation rows; W5 picks the smallest validation RMSE
    (ties by name)."""
    spark = train.sparkSession
    configs = configs or (LR_CONFIGS if kind == "lr" else RF_CONFIGS)
    feats = Pipeline(stages=encoder_stages(cats) + [assembler(num, cats)]).fit(train)
    tr = feats.transform(train).select("features", label).persist()
    va = feats.transform(valid).select("features", label).persist()
    models: dict[str, object] = {}

    def one(config):
        name, a, b = config
        stage = lr_stage(label, a, b) if kind == "lr" else rf_stage(label, int(a), int(b))
        models[name] = stage.fit(tr)
        m = regression_metrics(models[name].transform(va), label, PRED).first()
        return name, float(a), float(b), int(m["n"]), float(m["mae"]), float(m["rmse"]), float(m["r2"])
    try:
        n = tr.count()
        if kind == "rf" and n * sum(int(trees) for _, trees, _ in configs) > TREE_ROWS:
            parallelism = 1
        with ThreadPool(max(1, min(parallelism, len(configs)))) as pool:
            rows = pool.map(one, configs)
    finally:
        tr.unpersist()
        va.unpersist()
    pa, pb = ("reg_param", "elastic_net") if kind == "lr" else ("num_trees", "max_depth")
    res = spark.createDataFrame(rows, f"config string, {pa} double, {pb} double, n long, mae double, "
                                      f"rmse double, r2 double")
    best = min(rows, key=lambda r: (r[5], r[0]))[0]
    return GridOutcome(res, best, feats, models)


def optimality(rows: DataFrame, label: str, features: PipelineModel, model, reg: float = 0.0, elastic_net: float = 0.0) -> DataFrame:
    """M16 + M22: for each slot of a fitted linear model and its intercept the
    coefficient and how far it is from optimal on the rows it was fitted on
    (``leastsquares.violations``; 0 is optimal), from one aggregate of the rows."""
    names = [*feature_names(features), "(intercept)"]
    stats = LeastSquares.of(features.transform(rows), label, len(names) - 1)
    beta = model.coefficients.toArray()
    off = stats.violations(beta, model.intercept, reg, elastic_net)
    values = [(n, float(b), float(v)) for n, b, v in zip(names, [*beta, model.intercept], off)]
    return rows.sparkSession.createDataFrame(values, "variable string, coefficient double, violation double")


def from_table(rows: DataFrame, table: dict[str, float], num: list[str], cats: list[str]) -> Column:
    """The prediction of a coefficient table on raw columns: the numbers times
    their coefficients, plus that of the row's level of each category."""
    out = F.lit(table["(intercept)"])
    for c in num:
        out = out + F.col(c) * F.lit(table[c])
    for c in cats:
        start = f"{c}_ohe_"
        levels = [F.when(F.col(c) == n[len(start):], F.lit(v)).otherwise(0.0) for n, v in table.items() if n.startswith(start)]
        out = reduce(lambda a, b: a + b, levels, out)
    return out


def refit(develop: DataFrame, num: list[str], cats: list[str], label: str, kind: str, config) -> PipelineModel:
    """Refit every stage on all development rows."""
    _, a, b = config
    stage = lr_stage(label, a, b) if kind == "lr" else rf_stage(label, int(a), int(b))
    return full_pipeline(num, cats, stage).fit(develop)


def coefficient_table(model: PipelineModel, df: DataFrame, n: int | None = 12) -> DataFrame:
    """M22 + T3: coefficients by slot name plus the intercept, ordered by
    absolute size. Coefficients of a design with a full one-hot block are
    not unique; compare predictions, not coefficients."""
    names = feature_names(model)
    lr = model.stages[-1]
    rows = [(nm, float(c)) for nm, c in zip(names, lr.coefficients.toArray())] + [("(intercept)", float(lr.intercept))]
    out = df.sparkSession.createDataFrame(rows, "variable string, coefficient double").orderBy(
        F.desc(F.abs("coefficient")), "variable")
    return out.limit(n) if n else out


def importance_table(model: PipelineModel, df: DataFrame, n: int | None = 12) -> DataFrame:
    """Variance-impurity importances by slot name, largest first."""
    names = feature_names(model)
    rf = model.stages[-1]
    rows = [(nm, float(v)) for nm, v in zip(names, rf.featureImportances.toArray())]
    out = df.sparkSession.createDataFrame(rows, "variable string, importance double").orderBy(
        F.desc("importance"), "variable")
    return out.limit(n) if n else out


def predictions_on(test: DataFrame, predictors: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """One frame of the test rows with a column ``pred_<name>`` for each
    predictor, applied one after the other, so all score identical rows in one scan."""
    out = test
    for name, predict in predictors.items():
        out = predict(out).select(*out.columns, F.col(PRED).alias(f"pred_{name}"))
    return out


def compare_on_test(test: DataFrame, label: str, predictors: dict[str, Callable[[DataFrame], DataFrame]],
                    baseline: str | None = None) -> DataFrame:
    """Metrics of several predictors on identical test rows, in one
    pass; with a ``baseline`` also the % by which each RMSE differs from its."""
    joint = predictions_on(test, predictors)
    out = metrics_long(joint, label, {name: f"pred_{name}" for name in predictors})
    if baseline is None:
        return out
    base = out.where(F.col("model") == baseline).agg(F.max("rmse")).scalar()
    return out.withColumn("rmse_change_pct", F.lit(100.0) * (F.col("rmse") / base - F.lit(1.0)))
