"""Bounded training samples and a small logistic regression."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import crc_mod, saved

STEPS = 1_000_000


def _picked(key: Column, share: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(STEPS)) < share * STEPS


def excerpt(key: Column, max_chars: int | Column) -> Column:
    """The text, or ``max_chars`` characters of a longer one, from a place hashed from the key."""
    text, n = F.col("text"), F.length("text")
    max_chars = F.lit(max_chars) if isinstance(max_chars, int) else max_chars
    at = F.pmod(F.xxhash64(key, F.lit("excerpt")), F.greatest(n - max_chars + 1, F.lit(1))) + 1
    return F.when(n > max_chars, text.substr(at.cast("int"), max_chars.cast("int"))).otherwise(text)


def labelled_sample(documents: DataFrame, labels: DataFrame, column: str, per_class: int, max_chars: int,
                    folds: int = 3, held_out: int = 1) -> pd.DataFrame:
    """Rows (doc_id, text, y) of at most about ``per_class`` ids of either
    class (0, 1), picked by a hash of the id from the labels outside the held-out
    fold; of a text longer than ``max_chars`` an excerpt, empty or null ones are passed over. Only
    the ids, bounded so, are broadcast; a repeated id counts once."""
    known = (labels.select("doc_id", F.col(column).alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (crc_mod(F.col("doc_id"), folds) != held_out))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    share = F.lit(0.0)
    for y, count in n.items():
        share = F.when(F.col("y") == y, min(1.0, per_class / count)).otherwise(share)
    ids = known.where(_picked(F.col("doc_id"), share))
    fit = F.col("text").isNotNull() & (F.length("text") > 0)
    rows = (documents.select("doc_id", "text").where(fit).join(F.broadcast(ids), "doc_id")
            .withColumn("text", excerpt(F.col("doc_id"), max_chars))
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")))
    out = rows.toPandas()
    return out.sort_values("doc_id").reset_index(drop=True)


#: Classes whose shares may be broadcast (a few dozen bytes each).
MOST_BROADCAST_CLASSES = 200_000


def class_sample(documents: DataFrame, column: str, per_class: int, class_chars: int, most_chars: int, folds: int, held_out: int,
                 fewest: int = 5) -> pd.DataFrame:
    """Rows (doc_id, text, y) of documents of each value of ``column``, which
    the documents carry, outside the held-out fold. A class gets about
    ``class_chars`` characters, all classes together ``most_chars``, shared evenly among about
    ``per_class`` documents (fewer, but ``fewest`` at least, where a share is small): an excerpt
    from a hashed place of each, so no document stands for its class."""
    fit = (F.col("y").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)
           & (crc_mod(F.col("doc_id"), folds) != held_out))
    docs = documents.select("doc_id", "text", F.col(column).alias("y")).where(fit)
    counts = saved(docs.groupBy("y").agg(F.count(F.lit(1)).alias("n")), "classes")
    classes = counts.count()
    chars = max(1, min(class_chars, most_chars // max(1, classes)))
    each = max(fewest, min(per_class, chars // 100))
    shares = counts.select("y", F.least(F.lit(1.0), F.lit(float(each)) / F.col("n")).alias("share"),
                           F.ceil(F.lit(float(chars)) / F.least(F.lit(each), F.col("n"))).cast("int").alias("chars"))
    shares = F.broadcast(shares) if classes <= MOST_BROADCAST_CLASSES else shares.hint("merge")
    key = F.coalesce("doc_id", F.lit(-1))
    rows = (docs.join(shares, "y").where(_picked(key, F.col("share"))).withColumn("text", excerpt(key, F.col("chars")))
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    out = rows.select("doc_id", "text", "y").toPandas()
    return out.sort_values(["y", "doc_id"]).reset_index(drop=True)


class Logistic:
    """Ridge logistic regression by Newton steps over standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        y = np.asarray(y, float)
        self.mean, self.sd = (x.mean(0), np.maximum(x.std(0), 1e-9)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        # a class of one kind alone still gives a score inside (0, 1)
        prior = (y.sum() + 0.5) / (len(y) + 1)
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.sd])
        self.w = np.zeros(z.shape[1])
        self.w[0] = np.log(prior / (1 - prior))
        if 0 < y.sum() < len(y):
            pull = np.full(z.shape[1], ridge)
            pull[0] = 1e-6
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
                g = z.T @ (p - y) + pull * self.w
                h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull + 1e-9)
                step = np.linalg.solve(h, g)
                self.w -= np.clip(step, -5, 5)
                if np.abs(step).max() < 1e-8:
                    break

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(((x - self.mean) / self.sd) @ self.w[1:] + self.w[0], -30, 30)
        return 1 / (1 + np.exp(-z))
