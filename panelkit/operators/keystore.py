"""Key audits over a bucketed key store: A6 A7 E13 J1 E14 without a shuffle of the panel.

Counting, the semi join to repeated keys, the versions of a key and the flag
join all need the rows of a key together, which the buckets give. Only the
plain part (null and hot keys) goes through the general operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import keys as K
from panelkit.sources.buckets import KeyStore


def key_counts(store: KeyStore) -> DataFrame:
    """Rows of each key (column n)."""
    def one(df):
        return df.groupBy(*store.key).agg(F.count(F.lit(1)).alias("n"))
    return one(store.bucketed).unionByName(one(store.plain))


def key_audit(store: KeyStore, null_cols: list[str] | None = None) -> DataFrame:
    """A6 from the buckets: one aggregate of the key counts."""
    n = F.col("n")
    return key_counts(store).agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(n) - F.count(F.lit(1)), F.lit(0)).cast("long").alias("surplus_rows"),
        F.coalesce(F.sum(F.when(K.any_null(null_cols or store.key), n)), F.lit(0)).cast("long").alias("null_key_rows"))


def _bucketed_duplicates(store: KeyStore, content: list[str]) -> DataFrame:
    key = store.key
    repeated = store.bucketed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key)
    # complete keys: a plain equality keeps the buckets' partitioning
    rows = store.bucketed.select(*key, *[c for c in content if c not in key]).join(repeated.hint("merge"), key, "left_semi")
    versions = rows.groupBy(*key, *[c for c in content if c not in key]).agg(F.count(F.lit(1)).alias("_n"))
    return (versions.groupBy(*key).agg(F.sum("_n").cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_versions"))
            .withColumn("kind", F.when(F.col("n_versions") == 1, F.lit(K.EXACT)).otherwise(F.lit(K.CONFLICT))))


def duplicate_keys(store: KeyStore, content: list[str]) -> DataFrame:
    """A7 + E13: repeated keys with rows, versions and kind."""
    return _bucketed_duplicates(store, content).unionByName(K.duplicate_keys(store.plain, store.key, content))


def flag_duplicates(panel: KeyStore, source: KeyStore, content: list[str], flag: str = "duplicate_key", null_keys: str = "report") -> DataFrame:
    """J1 + E14 + U3: the rows of ``panel`` with a flag for the keys repeated in
    ``source``. Both stores must have the same key and buckets. An ordinary key of one store may be hot
    in the other, so each part is flagged by the repeated keys of both parts."""
    if (panel.key, panel.buckets) != (source.key, source.buckets):
        raise ValueError("the stores differ in key or buckets")
    key = panel.key
    ordinary = _bucketed_duplicates(source, content).select(*key).withColumn(flag, F.lit(True))
    rest = K.duplicate_keys(source.plain, key, content)
    out = panel.bucketed.join(ordinary.hint("merge"), key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    out = _either(out, rest.where(~K.any_null(key)), key, flag)
    plain = K.flag_duplicates(panel.plain, duplicate_keys(source, content), key, flag, null_keys)
    return out.unionByName(plain)


def _either(flagged: DataFrame, more: DataFrame, key: list[str], flag: str) -> DataFrame:
    """The flag, or that the key is in ``more`` (repeated keys that are not in the source's buckets: few, or in bad input many)."""
    got = K.flag_duplicates(flagged, more, key, "_more")
    return got.withColumn(flag, F.col(flag) | F.col("_more")).drop("_more")
