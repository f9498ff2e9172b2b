"""String functions: Column -> Column. White space, digits and stripping are Unicode-aware."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing value in free text.
MISSING_WORDS = ("UNKNOWN", "NONE")


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def is_missing(c: Column) -> Column:
    """Blank, or one of the words that stand for nothing."""
    return is_blank(c) | F.upper(strip(c)).isin(*MISSING_WORDS)


def normalize_title(c: Column) -> Column:
    """Stripped, lower case, white space runs as one blank; null gives the empty text."""
    return F.coalesce(F.regexp_replace(F.lower(strip(c)), r"(?U)\s+", " "), F.lit(""))


def clean_upc(c: Column) -> Column:
    """The digits alone; null if there are none."""
    return F.nullif(F.regexp_replace(c, r"(?U)\D", ""), F.lit(""))


def folded(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def tokens(c: Column) -> Column:
    """Distinct white-space tokens, the empty one never among them."""
    return F.array_distinct(F.filter(F.split(folded(c), r"(?U)\s+"), lambda x: x != ""))


def title_overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(tokens(a), tokens(b)))


def plain_number(c: Column) -> Column:
    """A number as text: without decimals when it is whole within a millionth."""
    n = c.cast("double")
    return F.when(F.abs(n - F.round(n)) < 1e-6, F.round(n).cast("long").cast("string")).otherwise(n.cast("string"))


def size_display(ml: Column, g: Column, count: Column) -> Column:
    """`{n} count, {n} ml, {n} g`, parts that are there; the empty text if none is."""
    part = lambda c, unit: F.when(c.isNotNull(), F.concat(plain_number(c), F.lit(f" {unit}")))
    return F.concat_ws(", ", part(count, "count"), part(ml, "ml"), part(g, "g"))


def embedding_text(title: Column, brand: Column, core: Column, flavor: Column, size: Column, category: Column) -> Column:
    """The title and the labelled attributes that are not missing."""
    labelled = lambda label, c: F.when(~is_missing(c), F.concat(F.lit(f"{label}: "), strip(c)))
    return F.concat_ws(", ", strip(title), labelled("brand", brand), labelled("core", core), labelled("flavor", flavor), labelled("size", size), labelled("category", category))
