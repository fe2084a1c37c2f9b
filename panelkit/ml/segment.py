"""KMeans segmentation with a documented choice of K (E15 E20 E21 M6-M12
A13 A14 R4 W2 W4).

Rows are grouped to distinct vectors with counts (``weighted``), on which
scaler, fits and scores are exact. Profiles, compositions and
descriptions are generic over the cluster column, so they work for any
segmentation (and are checked against SQL with a rule-based one).
"""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions.coerce import label_rank
from panelkit.functions.predicates import age_band, hours_band, tenure_band
from panelkit.ml.features import scaler
from panelkit.ml.weighted import WEIGHT, Moments, distinct_vectors, grid_scores, moments, scaler_of
from panelkit.operators.describe import quantiles
from panelkit.operators.joins import checked_join, cut, null_safe_join, total
from panelkit.operators.ranks import rank_table

SEED = 42
#: Vectors that the fits of a grid that run side by side may hold between them.
VECTORS_AT_ONCE = 10_000_000


def kmeans_stage(k: int, seed: int = SEED, max_iter: int = 100, init_steps: int = 5) -> KMeans:
    """M6: k-means|| init, Euclidean distance."""
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster", maxIter=max_iter,
                  initSteps=init_steps)


def kmeans_pipeline(cols: list[str], k: int, seed: int = SEED) -> Pipeline:
    """M6 as one pipeline: assemble -> standardise -> KMeans."""
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_kmx"), scaler("_kmx", "features"),
                            kmeans_stage(k, seed)])


def silhouette(pred: DataFrame) -> float:
    """M8: mean silhouette with squared Euclidean distance."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return ev.evaluate(pred)


@dataclass
class GridResult:
    results: DataFrame                          # option, k, silhouette, wssse, smallest_pct
    models: dict[tuple[str, int], PipelineModel]
    points: dict[str, DataFrame]                # distinct vectors with counts, by option
    moments: dict[str, Moments]


def kmeans_grid(df: DataFrame, feature_sets: dict[str, list[str]], ks: list[int], seed: int = SEED,
                parallelism: int = 8) -> GridResult:
    """M7: for each feature set the distinct vectors with their counts are
    written once; scaler, fits (``weightCol``) and scores work on them. All fits of
    the grid run side by side, ``parallelism`` at a time: a fit is many short
    jobs that wait for each other; of large sets fewer, so that their vectors stay in memory. The fits of a set share its cached vectors, and each iterates
    over blocks of numbers, a quarter of what a row's own objects take. Silhouette, WSSSE of the final centres and
    the smallest cluster share (%) of a set's fits come from a few scans."""
    spark = df.sparkSession
    points = {o: cut(distinct_vectors(df, cols)) for o, cols in feature_sets.items()}
    moments_ = {o: moments(points[o], cols) for o, cols in feature_sets.items()}
    stages, vectors = {}, {}
    for option, cols in feature_sets.items():
        stages[option] = [VectorAssembler(inputCols=cols, outputCol="_kmx"), scaler_of(spark, moments_[option], "_kmx", "features")]
        vectors[option] = PipelineModel(stages=stages[option]).transform(points[option]).select("features", WEIGHT).persist()

    def one(option: str, k: int) -> KMeansModel:
        return kmeans_stage(k, seed).setWeightCol(WEIGHT).setSolver("block").fit(vectors[option])
    keys = [(o, k) for o in feature_sets for k in ks]
    try:
        most = max(df.count() for df in vectors.values())
        with ThreadPool(max(1, min(parallelism, len(keys), VECTORS_AT_ONCE // max(1, most)))) as pool:
            fitted = dict(zip(keys, pool.starmap(one, keys)))
    finally:
        for df in vectors.values():
            df.unpersist()
    rows = []
    for option, cols in feature_sets.items():
        grid = {k: [list(map(float, c)) for c in fitted[option, k].clusterCenters()] for k in ks}
        for k, s in grid_scores(points[option], cols, moments_[option], grid).items():
            rows.append((option, k, s.silhouette, s.wssse, s.smallest_pct))
    res = spark.createDataFrame(rows, "option string, k int, silhouette double, wssse double, smallest_pct double")
    models = {key: PipelineModel(stages=[*stages[key[0]], km]) for key, km in fitted.items()}
    return GridResult(res, models, points, moments_)


def wssse_drop(results: DataFrame) -> DataFrame:
    """% WSSSE reduction to the next K within each option (null for
    the last K)."""
    w = Window.partitionBy("option").orderBy("k")
    return results.withColumn("wssse_drop_pct", F.lit(100.0) * (F.lit(1.0) - F.lead("wssse").over(w) / F.col("wssse")))


def choose_k(results: DataFrame, option: str | None = None, min_silhouette: float = 0.40,
             min_smallest_pct: float = 5.0, max_drop_pct: float = 10.0) -> DataFrame:
    """M9: valid K = silhouette >= 0.40 and smallest cluster >= 5 %; pick
    the least valid K whose WSSSE drop to the next K is < 10 %, else the
    valid K with the best silhouette (ties: smaller K). Returns one row
    (k, rule) or raises when no K is valid."""
    r = wssse_drop(results)
    if option is not None:
        r = r.where(F.col("option") == option)
    valid = r.where((F.col("silhouette") >= min_silhouette) & (F.col("smallest_pct") >= min_smallest_pct))
    elbow = valid.where(F.col("wssse_drop_pct") < max_drop_pct)
    pick = elbow.agg(F.min("k").alias("k")).withColumn("rule", F.lit("elbow"))
    best = (valid.orderBy(F.desc("silhouette"), F.asc("k")).limit(1)
            .select("k", F.lit("best_silhouette").alias("rule")))
    out = pick.where(F.col("k").isNotNull()).unionByName(best).orderBy(F.when(F.col("rule") == "elbow", 0)
                                                                      .otherwise(1)).limit(1)
    return out


def chosen_k(results: DataFrame, option: str | None = None, **kw) -> int:
    row = choose_k(results, option, **kw).first()
    if row is None:
        raise ValueError("no K meets the silhouette and cluster-size conditions")
    return int(row["k"])


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the cluster column, drop the work vectors."""
    return model.transform(df).drop("_kmx", "features")


def centroids(model: PipelineModel, cols: list[str]) -> DataFrame:
    """Cluster centres in original units (centre * sd + mean)."""
    sc, km = model.stages[1], model.stages[-1]
    mean, std = sc.mean.toArray(), sc.std.toArray()
    rows = [(i, *[float(c[j] * std[j] + mean[j]) for j in range(len(cols))])
            for i, c in enumerate(km.clusterCenters())]
    schema = "cluster int, " + ", ".join(f"{c} double" for c in cols)
    return SparkSession.getActiveSession().createDataFrame(rows, schema)


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cluster sizes and share (%), plus the smallest share."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    shares = sizes.withColumn("pct", F.lit(100.0) * F.col("n") / total(sizes, F.sum("n")))
    return shares.withColumn("smallest_pct", total(shares, F.min("pct")))


def cluster_profile(df: DataFrame, cluster: str, measures: list[str], wage: str, exact: bool = True) -> DataFrame:
    """Per cluster n, % of rows, mean and median of each measure
    (exact by default, ``percentile_approx`` with ``exact=False``; means
    unrounded - see ``describe.rounded`` for presentation)."""
    means = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                    *[F.avg(m).alias(f"{m}_mean") for m in measures + [wage]])
    means = means.withColumn("pct", F.lit(100.0) * F.col("n") / total(means, F.sum("n")))
    long = df.select(cluster, *[F.col(m).cast("double") for m in measures + [wage]]).unpivot(
        [cluster], measures + [wage], "variable", "value")
    med = quantiles(long, "value", [0.5], [cluster, "variable"], exact).groupBy(cluster).agg(
        *[F.max(F.when(F.col("variable") == m, F.col("q0"))).alias(f"{m}_median") for m in measures + [wage]])
    return null_safe_join(means, med, cluster)


def composition(df: DataFrame, cluster: str, col: str, order: list[str] | None = None) -> DataFrame:
    """R4 (long form): % of each cluster in each category, with the
    category's display rank (given order, or alphabetical)."""
    c = df.groupBy(cluster, col).agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy(cluster)))
    if order:
        return c.withColumn("rank", label_rank(col, order).cast("int"))
    # a category's place in the sorted vocabulary, null first: rows of a small
    # table of categories, ranked by ranges and joined back
    names = c.select(F.col(col).alias("_name"), F.lit("v").alias("_g")).distinct()
    ranked = rank_table(names.where(F.col("_name").isNotNull()), "_name", ["_g"]).select("_name", F.col("below").alias("_place"))
    nulls = total(c, F.max(F.col(col).isNull().cast("int")))
    placed = checked_join(c.withColumn("_name", F.col(col)), ranked, "_name", "left")
    place = F.when(F.col(col).isNull(), 0).otherwise(F.col("_place") + nulls)
    return placed.withColumn("rank", place.cast("int")).select(*c.columns, "rank")


def composition_wide(df: DataFrame, cluster: str, col: str, values: list[str], other: str = "other") -> DataFrame:
    """R4 (matrix): cluster x category % of all the cluster's rows, in the
    given column order; ``other`` holds the share of unlisted categories and nulls."""
    n = F.count(F.lit(1))
    listed = [F.count(F.when(F.col(col) == v, 1)) for v in values]
    rest = F.count(F.when(F.coalesce(~F.col(col).isin(values), F.lit(True)), 1))
    return df.groupBy(cluster).agg(*[(F.lit(100.0) * k / n).alias(v) for k, v in zip([*listed, rest], [*values, other])])


def modal_category(comp: DataFrame, cluster: str, col: str) -> DataFrame:
    """Per cluster the category with the largest share; ties go to the
    first category in display order."""
    w = Window.partitionBy(cluster).orderBy(F.desc("pct"), F.asc("rank"))
    return (comp.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select(cluster, F.col(col).alias(f"modal_{col}"), F.col("pct").alias(f"modal_{col}_pct")))


# The sentence's fixed words and the bands' texts must equal the study's.
def _capitalize(c):
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def describe_clusters(centres: DataFrame, cat_modal: DataFrame, edu_modal: DataFrame, cluster: str = "cluster",
                      age: str = "age", tenure: str = "tenure", hours: str = "hours",
                      cat: str = "category", edu: str = "education") -> DataFrame:
    """E20 + E21: profile sentence from fixed bands of the centre and the
    modal category (with its rounded %) and modal education."""
    j = centres.join(cat_modal, cluster).join(edu_modal, cluster)
    pct = F.round(F.col(f"modal_{cat}_pct"), 0).cast("long").cast("string")
    text = F.concat(
        _capitalize(age_band(age)), F.lit(", "), tenure_band(tenure), F.lit(", "), hours_band(hours),
        F.lit("; predomina "), F.lower(F.col(f"modal_{cat}")), F.lit(" ("), pct, F.lit("%) y nivel "),
        F.lower(F.col(f"modal_{edu}")))
    return j.select(cluster, text.alias("description"))
