"""Row-level predicates and derived scalar columns (JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.coerce import to_double


def should_answer(age_raw: str, employed_raw: str, category_raw: str) -> Column:
    """The person should have answered the labour module (15+,
    employed, salaried category), evaluated on raw text; null -> false.
    No finite guard, as in the survey's own audit."""
    cond = ((to_double(age_raw) >= 15) & (to_double(employed_raw) == 1)
            & to_double(category_raw).isin(1, 2, 3, 4))
    return F.coalesce(cond, F.lit(False))


def safe_log10(c: str | Column) -> Column:
    """log10 for positive values only, null otherwise (Spark gives
    null and other engines -inf for 0; the guard makes both agree)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x > 0, F.log10(x))


def residual(actual: str, predicted: str) -> Column:
    """Actual - predicted (positive = underestimate)."""
    return F.col(actual) - F.col(predicted)


def age_band(c: str | Column) -> Column:
    """E20 (fixed thresholds): < 35 young, < 55 adult, else older."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x < 35, "jóvenes").when(x < 55, "adultos").otherwise("adultos mayores")


def tenure_band(c: str | Column) -> Column:
    """< 5 low, <= 10 medium, else high tenure."""
    x = F.col(c) if isinstance(c, str) else c
    return (F.when(x < 5, "baja antigüedad").when(x <= 10, "antigüedad media")
            .otherwise("alta antigüedad"))


def hours_band(c: str | Column) -> Column:
    """< 35 part time, <= 48 standard, else extended week."""
    x = F.col(c) if isinstance(c, str) else c
    return (F.when(x < 35, "jornada parcial").when(x <= 48, "jornada estándar")
            .otherwise("jornada extendida"))


def pct_change(new: str | Column, old: str | Column) -> Column:
    """100 * (new / old - 1); null when old is 0 or null."""
    n = F.col(new) if isinstance(new, str) else new
    o = F.col(old) if isinstance(old, str) else old
    return F.lit(100.0) * (F.try_divide(n, o) - F.lit(1.0))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Num / den, null on a zero divisor."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n, d)
