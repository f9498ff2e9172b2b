"""Vectors as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    """Unit length; the zero vector stays as it is."""
    return F.transform(a, lambda x: F.when(l2_norm(a) > 0, x.cast("double") / l2_norm(a)).otherwise(x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    n = l2_norm(a) * l2_norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))
