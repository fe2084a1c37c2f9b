"""Sampling and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bernoulli_sample(df: DataFrame, n: int, seed: int = 42, total: int | None = None) -> DataFrame:
    """T5: Bernoulli sample with fraction min(1, n / N), then capped at n rows
    (so at most n, not exactly n). A row is drawn if a seeded hash of its
    content lies below the fraction, and the cap takes the smallest hashes, so
    the sample is the same under any partitioning. Equal rows share their draw."""
    total = df.count() if total is None else total
    frac = 1.0 if total == 0 else min(1.0, n / total)
    cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    draw = F.pmod(F.xxhash64(F.lit(seed), *cells), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return df.withColumn("_draw", draw).where(F.col("_draw") < frac).orderBy("_draw").limit(n).drop("_draw")


def key_hash(key: list[str]):
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))


def hash_sample(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The n rows with the smallest md5 of the key (ties by key, then
    by the other columns, so repeated keys are ordered too):
    reproducible under any partitioning. Planned as a per-partition top-n
    and a merge of at most n rows per partition."""
    rest = [c for c in df.columns if c not in key]
    return (df.withColumn("_h", key_hash(key))
            .orderBy("_h", *[F.asc_nulls_first(k) for k in key + rest]).limit(n).drop("_h"))


def first_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """First n rows for display (no order guarantee)."""
    return df.limit(n)
