"""Row-wise statistics and safe arithmetic, as plain column expressions (codegen-friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _count_present(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cols])


def row_mean(cols: list[Column]) -> Column:
    """Mean of the non-null values in ``cols``; NULL when all are NULL."""
    n = _count_present(cols)
    s = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    return F.when(n > 0, F.try_divide(s, n))


def row_std(cols: list[Column]) -> Column:
    """Sample standard deviation (ddof=1) of the non-null values; NULL below two values."""
    n = _count_present(cols)
    mean = row_mean(cols)
    ss = reduce(lambda a, b: a + b,
                [F.when(c.isNotNull(), (c - mean) * (c - mean)).otherwise(F.lit(0.0))
                 for c in cols])
    return F.when(n >= 2, F.sqrt(F.try_divide(ss, n - 1)))


def safe_ratio(numerator: Column, denominator: Column, eps: float = 1e-3) -> Column:
    """``numerator / (denominator + eps)``; NULL (not inf) where the sum is exactly 0."""
    return F.try_divide(numerator, denominator + F.lit(eps))


def segment_numeric(segment: Column) -> Column:
    """The number a segment label turns into when ``_`` separators are ignored."""
    return F.regexp_replace(segment, "_", "").try_cast("double")
