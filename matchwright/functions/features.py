"""Pair features and the weighted score. Thresholds are compared in the type of the score column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchwright.functions.text import folded


def same_text(a: Column, b: Column) -> Column:
    """1.0 if both are the same text but for case and outer blanks, and not blank. Words for a missing value count as texts."""
    return F.when((folded(a) != "") & (folded(a) == folded(b)), F.lit(1.0)).otherwise(F.lit(0.0))


def clamped(c: Column) -> Column:
    """Into [0, 1]; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c.cast("double"))))


def at_least(c: Column, threshold: float, kind: str) -> Column:
    """c >= threshold with the threshold rounded to the column's own type, so that float32 0.7 reaches 0.70."""
    return F.coalesce(c, F.lit(0.0).cast(kind)) >= F.lit(threshold).cast(kind)
