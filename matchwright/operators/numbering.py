"""Gapless row numbers and running sums without a window over one partition.

Rows are numbered in two passes: they are dealt by ranges and written once, the rows of each range are counted, and a row's
number is its place in its range after the counts of the ranges before it. Running sums over many keys work alike on blocks of
keys: sums within a block, sums of blocks before it, and blocks of blocks where there are too many of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchwright.operators.staging import written

#: Keys that one task sums over; and numbers of ranges (24 bytes each) that may go along with the tasks.
BLOCK, CARRIED = 4096, 1_000_000
#: monotonically_increasing_id is the partition above these bits and the place in it below.
PLACE_BITS = 33


def running_sums(df: DataFrame, order: str, sums: dict[str, str], most: int, group: tuple[str, ...] = (), block: int = BLOCK) -> DataFrame:
    """Adds, for each (new column: summed column), the sum over the rows with lower `order` in the row's group (nulls form one).

    `order` is an integer from 0 to below `most`, once in each group; sums of nulls and of no rows are 0.
    """
    part = f"{order}_block"
    before = lambda w: {new: F.coalesce(F.sum(old).over(w), F.lit(0)) for new, old in sums.items()}
    inside = Window.partitionBy(*group, part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    if most <= block:
        return df.withColumn(part, F.lit(0)).withColumns(before(inside)).drop(part)
    cut = df.withColumn(part, F.expr(f"cast({order} div {block} as long)"))
    totals = cut.groupBy(*group, part).agg(*[F.sum(old).alias(f"of_{new}") for new, old in sums.items()])
    above = running_sums(totals, part, {f"above_{new}": f"of_{new}" for new in sums}, -(-most // block), group, block)
    above = above.select(F.col(part).alias("at_block"), *[F.col(g).alias(f"in_{g}") for g in group], *[f"above_{new}" for new in sums])
    met: Column = F.col(part) == F.col("at_block")
    for g in group:
        met = met & F.col(g).eqNullSafe(F.col(f"in_{g}"))
    return cut.withColumns(before(inside)).join(above, met).withColumns({new: F.col(new) + F.col(f"above_{new}") for new in sums}).select(*df.columns, *sums)


def ranges(df: DataFrame, *order: Column | str) -> tuple[DataFrame, int]:
    """(the rows, dealt by ranges of `order`, sorted and written, with _part and _place; number of ranges)."""
    kept = written(df.repartitionByRange(*order).sortWithinPartitions(*order))
    n = kept.rdd.getNumPartitions()
    at = F.monotonically_increasing_id()
    return kept.withColumns({"_part": F.shiftright(at, PLACE_BITS), "_place": at.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}), n


def row_index(df: DataFrame, *order: Column | str, name: str = "row_index", carried: int = CARRIED) -> DataFrame:
    """Adds the rows' numbers from 0 without gaps, in the order given (which should tell rows apart)."""
    kept, n = ranges(df, *order)
    counts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = running_sums(counts, "_part", {"_start": "_n"}, n).select(F.col("_part").alias("_of"), "_start")
    starts = F.broadcast(starts) if n <= carried else starts
    return kept.join(starts, F.col("_part") == F.col("_of")).select(*df.columns, (F.col("_start") + F.col("_place")).alias(name))
