"""Join helpers: broadcast only behind a measured size in bytes, null-safe keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of values a side may hold to be broadcast.
MAX_BROADCAST_BYTES = 64 << 20


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint in the shared folder
    (``spark.checkpoint.dir``) and cut its lineage; later counts and joins
    read the checkpoint instead of recomputing the input, so its shuffle files go."""
    from panelkit.session import ensure_checkpoint_dir, shuffles_dropped
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def _width(c: Column, kind: T.DataType) -> Column:
    """Bytes of a value, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, T.ArrayType):
        each = F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + _width(x, kind.elementType).cast("long"))
        return F.lit(16) + F.coalesce(each, F.lit(0))
    return F.lit(16)


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of all values of ``df``: one aggregate."""
    row = reduce(lambda a, b: a + b, [_width(F.col(f"`{f.name}`"), f.dataType).cast("long") for f in df.schema.fields])
    return int(df.agg(F.sum(row)).first()[0] or 0)


def checked_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner",
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES, null_safe: bool = False) -> DataFrame:
    """Join with ``right`` broadcast only when its values hold at most
    ``max_broadcast_bytes``; otherwise a shuffle join (with adaptive splitting
    of hot keys on the big side). With ``null_safe`` null keys match."""
    right = cut(right)  # once: the measurement and the join read the checkpoint
    if size_in_bytes(right) <= max_broadcast_bytes:
        right = F.broadcast(right)
    else:
        right = right.hint("merge")
    return null_safe_join(left, right, on, how) if null_safe else left.join(right, on, how)


def null_safe_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null keys match each other; keys come out once, from ``left``."""
    keys = [on] if isinstance(on, str) else on
    other = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"__right_{k}"]) for k in keys], F.lit(True))
    return left.join(other, same, how).drop(*[f"__right_{k}" for k in keys])


def total(df: DataFrame, aggregate: Column) -> Column:
    """An aggregate over all rows of ``df``, as a scalar subquery: no window
    that gathers the table in one task."""
    return df.agg(aggregate).scalar()
