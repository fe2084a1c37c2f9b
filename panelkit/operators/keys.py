"""Key uniqueness audits and duplicate flags.

E12 E13 E14 A6 A7 A8 J1 J2 U2 U3 T2. Duplicates are classified and
flagged, never dropped. Every audit is a partial+final aggregation keyed
by the panel key, so a hot key (even a third of all rows) is combined
map-side before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.joins import MAX_BROADCAST_BYTES, checked_join, null_safe_join

EXACT = "exact_repeat"
CONFLICT = "conflict"


def row_signature(cols: list[str]) -> Column:
    """SHA-256 of the row content. JSON keeps nulls and field
    boundaries, so ("a|b","c") and ("a","b|c") differ."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}), 256)


def any_null(cols: list[str]) -> Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return cond


def key_audit(df: DataFrame, key: list[str], null_cols: list[str] | None = None) -> DataFrame:
    """Rows, distinct keys (null keys count, nulls equal), surplus rows
    and rows with a null key part, in one shuffle."""
    null_cols = null_cols or key
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.sum("n") - F.count(F.lit(1))).cast("long").alias("surplus_rows"),
        F.coalesce(F.sum(F.when(any_null(null_cols), F.col("n"))), F.lit(0)).cast("long").alias("null_key_rows"),
    )


def distinct_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Distinct key tuples (nulls equal)."""
    return df.select(*key).distinct()


def duplicate_keys(df: DataFrame, key: list[str], content: list[str], by_signature: bool = False) -> DataFrame:
    """A7 + E13: keys seen more than once, with row count, number of
    distinct content versions and kind (exact repeat vs conflict).

    The key alone is counted first. Over the rows of repeated keys, two
    combining aggregations follow - by key + content, then by key - instead
    of a COUNT DISTINCT, so a hot key is reduced map-side twice. Grouping
    on the content columns themselves compares them exactly and null-safely
    with no per-row serialisation; ``by_signature=True`` groups on the
    SHA-256 row signature instead (narrower shuffle for very wide rows).
    """
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key)
    # keys are normally unique: only rows of repeated ones bring their content along
    rows = null_safe_join(df.select(*key, *content), repeated, key, "left_semi")
    if by_signature:
        versions = rows.select(*key, row_signature(content).alias("_sig")).groupBy(*key, "_sig")
    else:
        versions = rows.groupBy(*key, *content)
    per_version = versions.agg(F.count(F.lit(1)).alias("_n"))
    return (per_version.groupBy(*key)
            .agg(F.sum("_n").cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_versions"))
            .withColumn("kind", F.when(F.col("n_versions") == 1, F.lit(EXACT)).otherwise(F.lit(CONFLICT))))


def duplicate_summary(dups: DataFrame, by: str = "period") -> DataFrame:
    """Keys and rows per period and kind."""
    return dups.groupBy(by, "kind").agg(F.count(F.lit(1)).alias("keys"), F.sum("n_rows").cast("long").alias("rows"))


def flag_duplicates(df: DataFrame, dups: DataFrame, key: list[str], flag: str = "duplicate_key",
                    null_keys: str = "report", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """J1 + E14 + U3: add a boolean flag for rows whose key is duplicated.

    ``null_keys="report"`` (default) mirrors an equi-join: null keys are
    reported by the audit but never flagged. ``"flag"`` matches null keys
    null-safely. The flag table is broadcast only when its measured size is
    under the bound; a large one (bad input) takes a shuffle join.
    """
    if null_keys not in ("report", "flag"):
        raise ValueError("null_keys must be 'report' or 'flag'")
    flags = dups.select(*key).withColumn(flag, F.lit(True))
    out = checked_join(df, flags, key, "left", max_broadcast_bytes, null_safe=null_keys == "flag")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def top_duplicates(dups: DataFrame, key: list[str], n: int = 10) -> DataFrame:
    """The n keys with most versions (then most rows), ties by key.
    Planned as a per-partition top-k + merge (TakeOrderedAndProject)."""
    return dups.orderBy(F.desc("n_versions"), F.desc("n_rows"), *[F.asc_nulls_first(k) for k in key]).limit(n)


def duplicate_examples(df: DataFrame, dups: DataFrame, key: list[str], n: int = 10) -> DataFrame:
    """Full rows of the top-n duplicate keys, sorted by key. Keys with
    a null part cannot be fetched by an equi-join, so examples are drawn
    from complete keys. The example side has at most n rows, so
    broadcasting it is bounded."""
    complete = dups.filter(~any_null(key))
    ex = top_duplicates(complete, key, n).select(*key, "kind")
    return df.join(F.broadcast(ex), key).orderBy(*key)
