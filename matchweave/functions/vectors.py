"""Vector expressions over array columns; whole-corpus search lives in ``operators``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_sum(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    return _fold_sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_fold_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of the angle; 0.0 when either vector is all zeros."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale)


def cosine_distance(a: Column, b: Column) -> Column:
    """Distance in [0, 2]; NaN when either vector is all zeros, so that it sorts last."""
    scale = norm(a) * norm(b)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / scale))
    return F.when(scale == 0, F.lit(float("nan"))).otherwise(1.0 - cosine)


def has_dim(a: Column, dim: int) -> Column:
    """True for a vector of the table's dimension; null vectors are not valid either."""
    return a.isNotNull() & (F.size(a) == dim)


def max_abs_diff(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))
