"""Distinct vectors with counts in place of rows, and what they give exactly:
moments, the fitted scaler, and the scores of a whole grid of segmentations.

Ages, months and hours take few values, so a panel of any size has a bounded
number of distinct vectors. A sum over rows is a sum over vectors weighted by
their counts, so KMeans with ``weightCol``, its cost and the silhouette keep
their values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.ml.features import scaler

WEIGHT = "_weight"


def distinct_vectors(df: DataFrame, cols: list[str]) -> DataFrame:
    """The distinct values of ``cols`` (as doubles) with the number of their rows."""
    return df.groupBy(*[F.col(c).cast("double").alias(c) for c in cols]).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))


@dataclass(frozen=True)
class Moments:
    """Rows, means and sample standard deviations of the rows that vectors stand for."""

    n: float
    mean: list[float]
    sd: list[float]

    def scaled(self, cols: list[str]) -> list[Column]:
        """(x - mean) / sd of each column; zero where a column is constant."""
        return [(F.col(c) - F.lit(m)) * F.lit(1.0 / s if s > 0 else 0.0) for c, m, s in zip(cols, self.mean, self.sd)]


def moments(points: DataFrame, cols: list[str], weight: str = WEIGHT) -> Moments:
    """Two aggregates of the weighted vectors, the second about the means."""
    w = F.col(weight)
    first = points.agg(F.sum(w).alias("n"), *[(F.sum(w * F.col(c)) / F.sum(w)).alias(f"m{j}") for j, c in enumerate(cols)]).first()
    n, mean = first["n"], [first[f"m{j}"] for j in range(len(cols))]
    if not n:
        raise ValueError("no rows to scale")
    about = points.agg(*[F.sum(w * F.pow(F.col(c) - F.lit(m), 2)).alias(f"s{j}") for j, (c, m) in enumerate(zip(cols, mean))]).first()
    return Moments(n, mean, [(s / (n - 1)) ** 0.5 if n > 1 else 0.0 for s in about])


def scaler_of(spark: SparkSession, m: Moments, inp: str, out: str) -> StandardScalerModel:
    """A scaler with the given moments: fitted on two rows that have them."""
    half = 0.5 ** 0.5
    rows = [(Vectors.dense([a + sign * half * s for a, s in zip(m.mean, m.sd)]),) for sign in (-1.0, 1.0)]
    return scaler(inp, out).fit(spark.createDataFrame(rows, [inp]))


def _nearest(z: list[Column], centres: list[list[float]]) -> Column:
    """(squared distance, number) of the nearest centre; the first of equal ones."""
    gaps = [F.struct(reduce(lambda a, b: a + b, [F.pow(x - F.lit(float(y)), 2) for x, y in zip(z, c)]).alias("d"), F.lit(i).alias("c"))
            for i, c in enumerate(centres)]
    return F.array_min(F.array(*gaps))


def cluster_moments(points: DataFrame, cols: list[str], m: Moments, grid: dict[int, list[list[float]]], weight: str = WEIGHT) -> DataFrame:
    """One scan for the whole grid {k: centres in scaled units}: for each k and
    cluster with rows, n, the sums of the scaled columns (s0, s1, ...), of
    their squares (sq) and of the squared distances to the centre (cost)."""
    z = [F.col(f"_z{j}") for j in range(len(cols))]
    base = points.select(F.col(weight).alias("_w"), *[x.alias(f"_z{j}") for j, x in enumerate(m.scaled(cols))])
    assigned = [F.struct(F.lit(k).alias("k"), _nearest(z, c).alias("near")) for k, c in grid.items()]
    long = base.select("_w", *z, F.inline(F.array(*assigned)))
    w, square = F.col("_w"), reduce(lambda a, b: a + b, [x * x for x in z])
    return long.groupBy("k", F.col("near.c").alias("cluster")).agg(
        F.sum(w).alias("n"), *[F.sum(w * x).alias(f"s{j}") for j, x in enumerate(z)], F.sum(w * square).alias("sq"),
        F.sum(w * F.col("near.d")).alias("cost"))


@dataclass(frozen=True)
class Scores:
    """Of one segmentation: mean silhouette (None for a single cluster), cost, smallest share in %."""

    silhouette: float | None
    wssse: float
    smallest_pct: float


def grid_scores(points: DataFrame, cols: list[str], m: Moments, grid: dict[int, list[list[float]]], weight: str = WEIGHT) -> dict[int, Scores]:
    """Scores of every k of the grid: a scan of the vectors for all moments, and one for each k, in one job.

    A row's mean squared distance to cluster j is |x|^2 + sq_j/n_j - 2 x.s_j/n_j,
    so the moments of at most sum(k) clusters answer all silhouettes at once. The own cluster's
    mean leaves the row out; the row of a cluster of one scores 0.
    """
    table: dict[int, dict[int, object]] = {k: {} for k in grid}
    for r in cluster_moments(points, cols, m, grid, weight).collect():
        table[r["k"]][r["cluster"]] = r
    z = [F.col(f"_z{j}") for j in range(len(cols))]
    square = reduce(lambda a, b: a + b, [x * x for x in z])
    means = []
    for i, (k, rows) in enumerate(table.items()):
        # a scan and a stage for each k, step by step: all of the grid in one would outgrow a compiled method
        base = points.select(F.col(weight).alias("_w"), *[x.alias(f"_z{j}") for j, x in enumerate(m.scaled(cols))])
        base = base.withColumns({"_sq": square, "_own": _nearest(z, grid[k])["c"]})
        base = base.withColumns({f"_gap{c}": F.col("_sq") + F.lit(r["sq"] / r["n"]) - F.lit(2.0) * reduce(
            lambda a, b: a + b, [x * F.lit(r[f"s{j}"] / r["n"]) for j, x in enumerate(z)]) for c, r in rows.items()})
        own, mine = F.col("_own"), F.lit(None).cast("double")
        for c, r in rows.items():
            if r["n"] > 1 and len(rows) > 1:
                mine = F.when(own == c, F.col(f"_gap{c}") * F.lit(r["n"] / (r["n"] - 1))).otherwise(mine)
        others = [F.when(own != c, F.col(f"_gap{c}")) for c in rows]
        a, b = F.col("_a"), F.col("_b")
        score = F.when(a < b, F.lit(1.0) - a / b).when(a > b, b / a - F.lit(1.0)).otherwise(0.0)
        base = base.withColumns({"_a": mine, "_b": F.least(*others) if len(others) > 1 else F.lit(None).cast("double")})
        score = score if len(rows) > 1 else F.lit(None).cast("double")
        means.append(base.agg((F.sum(F.col("_w") * score) / F.sum("_w")).alias("mean")).select(F.lit(i).alias("i"), "mean"))
    mean = {r["i"]: r["mean"] for r in reduce(lambda a, b: a.unionByName(b), means).collect()}
    return {k: Scores(mean[i], sum(r["cost"] for r in table[k].values()),
                      100.0 * min(r["n"] for r in table[k].values()) / m.n) for i, k in enumerate(grid)}
