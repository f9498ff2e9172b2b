"""Exact order statistics of many values for a few keys: no task holds the values of a key.

Equal values are one row with a number before anything moves. The rows are dealt by ranges of (key, value); the numbers before a
range are running sums over ranges, and the wanted ranks are read off where they fall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchwright.operators.numbering import ranges, running_sums
from matchwright.operators.staging import written


def summary(values: DataFrame, key: str, x: str, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """key, count, mean, std (sample), min, p{share in percent} (interpolated) and max of the values that are not null.

    Keys without a value come with count 0 and nulls. NaN sorts above all numbers.
    """
    once = written(values.groupBy(F.col(key).alias("key"), F.col(x).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n")))
    there = once.where("x is not null")
    moments = there.groupBy("key").agg(F.sum("n").alias("count"), F.sum(F.col("x") * F.col("n")).alias("total"), F.min("x").alias("min"), F.max("x").alias("max"))
    moments = written(moments.withColumn("mean", F.col("total") / F.col("count")))
    about = lambda *names: F.broadcast(moments.select(F.col("key").alias("of"), *names))  # noqa: E731  one row for each key
    same = F.col("key").eqNullSafe(F.col("of"))
    spread = there.join(about("mean"), same).groupBy("key").agg(F.sum(F.pow(F.col("x") - F.col("mean"), F.lit(2)) * F.col("n")).alias("square"))
    sorted_, parts = ranges(there, "key", "x")
    by_part = sorted_.groupBy("_part", "key").agg(F.sum("n").alias("m"))
    starts = running_sums(by_part, "_part", {"start": "m"}, parts, ("key",)).select(F.col("_part").alias("_of_part"), F.col("key").alias("_of_key"), "start")
    inside = Window.partitionBy("_part", "key").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    placed = sorted_.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.join(starts, (F.col("_part") == F.col("_of_part")) & F.col("key").eqNullSafe(F.col("_of_key"))).withColumn("from", F.col("start") + F.col("inside"))
    at = lambda q: (F.col("count") - 1) * F.lit(q)
    holds = lambda rank: (F.col("from") <= rank) & (rank < F.col("from") + F.col("n"))
    low, high = (lambda q: F.floor(at(q))), (lambda q: F.ceil(at(q)))
    wanted = placed.join(about("count"), same)
    any_rank: Column = F.lit(False)
    for q in shares:
        any_rank = any_rank | holds(low(q)) | holds(high(q))
    read = wanted.where(any_rank).groupBy("key").agg(
        *[F.max(F.when(holds(f(q)), F.col("x"))).alias(f"{side}{i}") for i, q in enumerate(shares) for side, f in (("low", low), ("high", high))]
    )
    join_on = lambda df, names: df.select(F.col("key").alias("of"), *names)
    out = once.select("key").distinct()
    for df, names in ((moments, ["count", "mean", "min", "max"]), (spread, ["square"]), (read, [f"{s}{i}" for i in range(len(shares)) for s in ("low", "high")])):
        out = out.join(join_on(df, names), same, "left").drop("of")
    between = [
        F.when(F.col(f"low{i}") == F.col(f"high{i}"), F.col(f"low{i}")).otherwise(F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * (at(q) - F.floor(at(q)))).alias(f"p{100 * q:g}")
        for i, q in enumerate(shares)
    ]
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("square") / (F.col("count") - 1))).alias("std")
    return out.select(F.col("key").alias(key), F.coalesce("count", F.lit(0)).alias("count"), "mean", deviation, "min", *between, "max")
