"""Departments to categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first row of which a word stands in the department names the category.
RULES = (
    (("produce", "fruit", "vegetable"), "fresh_produce"),
    (("meat",), "meat"),
    (("seafood", "fish"), "seafood"),
    (("dairy", "milk", "cheese"), "dairy"),
    (("egg",), "eggs"),
    (("bakery", "bread"), "bakery"),
    (("frozen",), "frozen_food"),
    (("alcohol", "wine", "beer", "liquor"), "alcohol"),
    (("beverage", "drink", "soda", "juice"), "beverage_non_alcohol"),
    (("snack", "chips", "candy", "cookies"), "snacks"),
    (("cereal", "breakfast"), "breakfast_cereal"),
    (("baby",), "baby"),
    (("pet",), "pet"),
    (("household", "clean", "paper"), "household"),
    (("personal", "beauty", "hair", "skin"), "personal_care"),
)
OTHERWISE, UNKNOWN = "pantry", "other_unknown"


def map_department(c: Column) -> Column:
    low, out = F.lower(c), F.lit(OTHERWISE)
    for words, category in reversed(RULES):
        hit = low.contains(words[0])
        for w in words[1:]:
            hit = hit | low.contains(w)
        out = F.when(hit, F.lit(category)).otherwise(out)
    return F.when(c.isNull(), F.lit(UNKNOWN)).otherwise(out)
