"""Sizes: parsing, normalisation, comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZE = r"((?U)\d+(?:\.\d+)?)(?U)\s*([a-zA-Z]+)"

# What one unit is in millilitres, grams or pieces.
UNITS = {
    "ml": ("ml", 1.0),
    "l": ("ml", 1000.0),
    "lt": ("ml", 1000.0),
    "liter": ("ml", 1000.0),
    "g": ("g", 1.0),
    "kg": ("g", 1000.0),
    "kgs": ("g", 1000.0),
    "oz": ("g", 28.3495),
    "ounce": ("g", 28.3495),
    "ounces": ("g", 28.3495),
    "lb": ("g", 453.592),
    "lbs": ("g", 453.592),
    "ct": ("count", 1.0),
    "cnt": ("count", 1.0),
    "count": ("count", 1.0),
    "pk": ("count", 1.0),
    "pack": ("count", 1.0),
}

# Similarity by the ratio of the larger size to the smaller, and the ratio that counts as equal.
RATIO_STEPS = ((1.25, 1.0), (1.5, 0.7), (2.0, 0.4))
EQUAL_RATIO = 1.05


def parsed_value(title: Column) -> Column:
    """The number of the first number-and-letters in a title, whether its unit is known or not."""
    return F.nullif(F.regexp_extract(title, SIZE, 1), F.lit("")).try_cast("double")


def parsed_unit(title: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(title, SIZE, 2), F.lit("")))


def normalized_unit(unit: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind in ("count", "g", "ml"):
        out = F.when(F.lower(unit).isin(*[u for u, (k, _) in UNITS.items() if k == kind]), F.lit(kind)).otherwise(out)
    return out


def normalized_size(value: Column, unit: Column, kind: str) -> Column:
    """The value in `kind` (ml, g or count); null if the unit is of another kind or unknown."""
    out = F.lit(None).cast("double")
    for u, (k, factor) in UNITS.items():
        if k == kind:
            out = F.when(F.lower(unit) == u, value * F.lit(factor)).otherwise(out)
    return F.when(value.isNotNull(), out)


def size_pair(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """struct(a, b) of the first of ml, g, count that both sides have; null fields otherwise."""
    out = F.struct(F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    for kind in ("count", "g", "ml"):
        x, y = (F.nanvl(side[kind].cast("double"), F.lit(None).cast("double")) for side in (a, b))
        out = F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("a"), y.alias("b"))).otherwise(out)
    return out


def ratio(a: Column, b: Column) -> Column:
    """Larger by smaller; null unless both are positive."""
    return F.when((a > 0) & (b > 0), F.greatest(a, b) / F.least(a, b))


def size_similarity(a: Column, b: Column) -> Column:
    r, out = ratio(a, b), F.lit(0.0)
    for most, value in reversed(RATIO_STEPS):
        out = F.when(r <= most, F.lit(value)).otherwise(out)
    return out


def size_strict(a: Column, b: Column) -> Column:
    return F.when(ratio(a, b) <= EQUAL_RATIO, F.lit(1.0)).otherwise(F.lit(0.0))


def main_size(ml: Column, g: Column, count: Column) -> Column:
    return F.coalesce(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")) for c in (ml, g, count)])
