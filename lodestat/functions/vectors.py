"""Array-vector expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null when one has length zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), n))


def squared_distance(a: Column, centre: list[float]) -> Column:
    """Squared Euclidean distance to a literal point, unrolled so it compiles."""
    total = F.lit(0.0)
    for i, c in enumerate(centre):
        d = a[i] - F.lit(float(c))
        total = total + d * d
    return total


def l1_distance(a: Column, centre: list[float]) -> Column:
    total = F.lit(0.0)
    for i, c in enumerate(centre):
        total = total + F.abs(a[i] - F.lit(float(c)))
    return total
