"""Vector arithmetic on arrays, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import bound


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalized(a: Column) -> Column:
    """The vector divided by its norm; a zero vector stays."""
    return bound(norm(a), lambda n: F.when(n > 0, F.transform(a, lambda x: (x / n).cast("float"))).otherwise(a.cast("array<float>")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; NULL where either is zero."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)
