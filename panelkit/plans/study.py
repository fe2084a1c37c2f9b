"""The whole survey study as one run: every report table is written as
Parquet under ``out`` (a shared folder on a cluster).

Steps: ingested raw table -> prepared (typed + marked) panel -> rule
cascade, missing and key audits -> descriptive statistics and
correlations -> KMeans segmentation with K choice and profiles ->
regression grids on validation, refit on development, comparison on the
test period -> error analysis. Each table is computed by Spark and
written; nothing is collected except bounded scalars (means, a
threshold, the chosen K and configurations).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from panelkit.functions.coerce import to_id
from panelkit.functions.predicates import safe_log10, should_answer
from panelkit.ml import regress as RG
from panelkit.ml import segment as SG
from panelkit.operators import corr as CR
from panelkit.operators import describe as D
from panelkit.operators import errors as ER
from panelkit.operators import keys as K
from panelkit.operators import missing as M
from panelkit.operators import rules as R
from panelkit.operators.harmonise import prepare_panel
from panelkit.plans.survey import (CONTENT_COLUMNS, EDUCATION_ORDER, FEATURE_CATEGORIES, FEATURE_NUMERIC, KEY,
                                   NUMERIC_VARS, RAW_COLUMNS, RULE_NAMES, SURVEY_SPEC, TARGET, survey_rules)
from panelkit.sources.storage import save_model, write_parquet


@dataclass(frozen=True)
class Protocol:
    train: Column
    validate: Column
    develop: Column
    test: Column


def run_study(raw: DataFrame, out: str, protocol: Protocol, ks: list[int] | None = None) -> dict[str, str]:
    """Run the study on an ingested raw table (canonical text + provenance)
    and return {table name: path}."""
    spark = raw.sparkSession
    out = out.rstrip("/")
    written: dict[str, str] = {}

    def save(name: str, df: DataFrame) -> None:
        path = f"{out}/{name}"
        write_parquet(df, path)
        written[name] = path

    # prepared panel (typed + marked), partitioned by period
    panel_path = f"{out}/panel_marked"
    prepare_panel(raw, SURVEY_SPEC, survey_rules(), panel_path)
    marked = spark.read.parquet(panel_path)
    kept = R.keep_rows(marked)

    # quality: cascade, missing data, key audits, duplicate flags
    save("cascade", R.cascade_table(marked, RULE_NAMES))
    save("remaining_after_rule", R.exclusion_cascade(marked, RULE_NAMES))
    save("missing", M.missing_table(raw, RAW_COLUMNS))
    save("missing_by_flag", M.missing_by_flag(raw, should_answer("P02A03", "OCUPADOS", "P05C16"), {
        "P05D01": "wage", "P05C07A": "tenure_years", "P05C07B": "tenure_months", "P05H01A": "hours"}))
    keyed = raw.withColumns({"household": to_id("NUM_HOGAR"), "person": to_id("NUM_PERSONA")})
    save("key_audit_raw", K.key_audit(keyed, KEY, ["household", "person"]))
    save("key_audit_kept", K.key_audit(kept, KEY, ["household", "person"]))
    dups = K.duplicate_keys(keyed, KEY, CONTENT_COLUMNS)
    save("duplicates", dups)
    save("duplicate_summary", K.duplicate_summary(dups))
    prepared = K.flag_duplicates(kept, dups, KEY)
    prepared_path = f"{out}/prepared"
    prepared.write.mode("overwrite").partitionBy("period").parquet(prepared_path)
    written["prepared"] = prepared_path
    prep = spark.read.parquet(prepared_path)

    # description and correlation (development rows)
    dev = prep.where(protocol.develop)
    save("profile", D.numeric_profile(dev, NUMERIC_VARS))
    save("freq_category", D.frequencies(dev, "category"))
    save("freq_education", D.frequencies(dev, "education", EDUCATION_ORDER))
    save("freq_domain", D.frequencies(dev, "domain"))
    save("median_by_education", D.group_quantiles(dev, "education", TARGET))
    save("median_by_category", D.group_quantiles(dev, "category", TARGET))
    save("per_period", D.per_period(dev, TARGET))
    save("hist_linear", _hist(dev, False))
    save("hist_log10", _hist(dev, True))
    save("box_education_category", _box(dev))
    save("pearson", CR.pearson_matrix(dev, NUMERIC_VARS))
    save("spearman", CR.spearman_matrix(dev, NUMERIC_VARS))

    # segmentation
    base = dev.withColumn("log_wage", safe_log10(TARGET))
    grid = SG.kmeans_grid(base, {"A_without_wage": FEATURE_NUMERIC,
                                 "B_with_log_wage": FEATURE_NUMERIC + ["log_wage"]}, ks or [2, 3, 4, 5])
    save("kmeans_grid", SG.wssse_drop(grid.results))
    k = SG.chosen_k(grid.results, "A_without_wage")
    model = grid.models[("A_without_wage", k)]
    seg = SG.assign_clusters(model, base)
    save("clusters", seg.select(*KEY, "cluster"))
    save("cluster_profile", SG.cluster_profile(seg, "cluster", FEATURE_NUMERIC, TARGET))
    save("centroids", SG.centroids(model, FEATURE_NUMERIC))
    comp_cat = SG.composition(seg, "cluster", "category")
    comp_edu = SG.composition(seg, "cluster", "education", EDUCATION_ORDER)
    save("composition_category", comp_cat)
    save("composition_education", comp_edu)
    save("cluster_description", SG.describe_clusters(
        SG.centroids(model, FEATURE_NUMERIC), SG.modal_category(comp_cat, "cluster", "category"),
        SG.modal_category(comp_edu, "cluster", "education")))

    # regression under the temporal protocol
    train, valid, test = prep.where(protocol.train), prep.where(protocol.validate), prep.where(protocol.test)
    lr = RG.fit_grid(train, valid, FEATURE_NUMERIC, FEATURE_CATEGORIES, TARGET, "lr")
    rf = RG.fit_grid(train, valid, FEATURE_NUMERIC, FEATURE_CATEGORIES, TARGET, "rf")
    save("lr_grid", lr.results)
    save("rf_grid", rf.results)
    lr_model = RG.refit(dev, FEATURE_NUMERIC, FEATURE_CATEGORIES, TARGET, "lr",
                        next(c for c in RG.LR_CONFIGS if c[0] == lr.best))
    rf_model = RG.refit(dev, FEATURE_NUMERIC, FEATURE_CATEGORIES, TARGET, "rf",
                        next(c for c in RG.RF_CONFIGS if c[0] == rf.best))
    save_model(lr_model, f"{out}/models/linear_regression")
    save_model(rf_model, f"{out}/models/random_forest")
    save("lr_coefficients", RG.coefficient_table(lr_model, dev, None))
    save("rf_importances", RG.importance_table(rf_model, dev, None))
    predictors = {"baseline_mean": lambda d: RG.mean_baseline(dev, d, TARGET),
                  "linear_regression": lr_model.transform, "random_forest": rf_model.transform}
    save("comparison_test", RG.compare_on_test(test, TARGET, predictors, "baseline_mean"))

    # error analysis: both models applied to the same test rows
    joint = RG.predictions_on(test, {"lr": lr_model.transform, "rf": rf_model.transform})
    joint = ER.add_residuals(joint, TARGET, {"lr": "pred_lr", "rf": "pred_rf"})
    save("errors_by_education", ER.errors_by_group(joint, "education", ["lr", "rf"]))
    save("errors_by_domain", ER.errors_by_group(joint, "domain", ["lr", "rf"]))
    p90 = D.scalar_quantile(test, TARGET, 0.9).first()[0]
    save("errors_by_p90", ER.errors_by_threshold(joint, TARGET, p90, ["lr", "rf"]))
    return written


def _hist(df: DataFrame, log: bool) -> DataFrame:
    from panelkit.operators.charts import histogram
    return histogram(df, TARGET, 80, log10=log)


def _box(df: DataFrame) -> DataFrame:
    from panelkit.operators.charts import box_stats
    return box_stats(df, TARGET, ["education", "category"])
