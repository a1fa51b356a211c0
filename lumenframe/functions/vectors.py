"""Vector functions on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 1e-9) -> Column:
    return dot(a, b) / ((norm(a) + eps) * (norm(b) + eps))


def sign_hash(a: Column) -> Column:
    """A hash of the signs alone, which tells equal identities without the vector."""
    return F.sha2(F.array_join(F.transform(a, lambda x: F.when(x >= 0, "1").otherwise("0")), ""), 256)


def unit(a: Column, eps: float = 0.0) -> Column:
    """The vector over its length; a zero vector stays."""
    n = norm(a) + eps
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(0.0))


def iou(a: Column, b: Column, eps: float = 1e-6) -> Column:
    """Intersection over union of boxes (structs x1, y1, x2, y2)."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
    area = lambda s: (s["x2"] - s["x1"]) * (s["y2"] - s["y1"])
    inter = side("x1", "x2") * side("y1", "y2")
    return inter / (area(a) + area(b) - inter + eps)
