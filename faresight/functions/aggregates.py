"""Aggregate expression builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faresight.functions.scalar import col_or_name

__all__ = ["first_non_null", "guarded_corr"]


def first_non_null(c, order_key="Id") -> Column:
    """First non-null value of a group, deterministic: the value on the row with
    the smallest ``order_key`` among non-null rows (G4)."""
    c = col_or_name(c)
    return F.min_by(c, F.when(c.isNotNull(), col_or_name(order_key)))


def guarded_corr(x, y) -> Column:
    """Pearson correlation that gives NaN (not an error / null) for n = 1 and for
    constant inputs, like the reference (S15).  Only rows where both are
    non-null contribute."""
    x, y = col_or_name(x), col_or_name(y)
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x.cast("double"))
    ys = F.when(both, y.cast("double"))
    sx = F.stddev_pop(xs)
    sy = F.stddev_pop(ys)
    cov = F.covar_pop(xs, ys)
    return (F.when(F.count(xs) == 0, F.lit(None).cast("double"))
            .when((sx == 0) | (sy == 0), F.lit(float("nan")))
            .otherwise(F.try_divide(cov, sx * sy)))

