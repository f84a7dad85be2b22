"""Array-vector maths as higher-order SQL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def l2_distance(a, b) -> Column:
    diff = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") - y)
    return F.sqrt(F.aggregate(diff, F.lit(0.0), lambda s, v: s + v * v))


def cosine_similarity(a, b) -> Column:
    """Null for a zero vector."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def vec_add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") + y)


def vec_scale(a, s) -> Column:
    s = F.lit(s) if isinstance(s, (int, float)) else _c(s)
    return F.transform(_c(a), lambda x: x.cast("double") * s)


def softmax(a) -> Column:
    """exp(x - max) / sum: numerically stable softmax over an array."""
    arr = _c(a)
    m = F.array_max(arr)
    ex = F.transform(arr, lambda x: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda s, v: s + v)
    return F.transform(ex, lambda v: v / total)


def sharpen(a, temperature: float) -> Column:
    """Temperature sharpening ``p^(1/T) / sum p^(1/T)``."""
    pw = F.transform(_c(a), lambda x: F.pow(x, F.lit(1.0 / temperature)))
    total = F.aggregate(pw, F.lit(0.0), lambda s, v: s + v)
    return F.transform(pw, lambda v: v / total)
