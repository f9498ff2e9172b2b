"""The nearest product of one code: for each left product the right one of least size difference, then largest title overlap, then least id.

Codes with few right products are joined: a left product meets `FEW` of them at most. For other codes pairs are never made. Each side is first reduced to distinct (code, size, bag of title words), the right one with its
least id. Sizes of both sides are merged in order, dealt by ranges so that a hot code lies in many tasks, and each left size
gets its neighbours below and above; products without a size stand at a fixed difference from all. Titles are compared only
among the right products at the least difference: where these are few, by a join; where they are many, in blocks of
both sides over lists of words, of which only the best of each left bag comes out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchwright.functions import text
from matchwright.operators.numbering import ranges
from matchwright.operators.staging import written

#: What a pair without both sizes differs by.
NO_SIZE = 9999.0
#: Right bags at one difference that a join may bring to each left bag; and bags in a block beyond it.
FEW, LEFT_BLOCK, RIGHT_BLOCK = 32, 4_000, 20_000
SIZED, UNSIZED, ALL = 0, 1, 2


def bag(title: Column) -> Column:
    """The distinct words of a title in order, as one text: words hold no blank."""
    return F.array_join(F.array_sort(text.tokens(title)), " ")


def neighbours(sizes: DataFrame) -> DataFrame:
    """code, size, below, above: of (code, size, right) each left size with the right sizes next to it, its own included.

    `right` tells the sides apart; sizes are not null and each stands once or twice for a code.
    """
    points = sizes.groupBy("code", "size").agg(F.max("right").alias("has_right"), F.min("right").alias("all_right"))
    dealt, _ = ranges(points, "code", "size")
    own = F.when(F.col("has_right"), F.col("size"))
    edges = dealt.groupBy("code", "_part").agg(F.max(own).alias("last"), F.min(own).alias("first"))  # more than one for hot codes only
    across = Window.partitionBy("code").orderBy("_part")
    edges = edges.select(
        F.col("code").alias("of"), F.col("_part").alias("at"),
        F.max("last").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.min("first").over(across.rowsBetween(1, Window.unboundedFollowing)).alias("after"),
    )
    inside = Window.partitionBy("code", "_part").orderBy("size")
    placed = dealt.withColumns(
        {"below": F.max(own).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "above": F.min(own).over(inside.rowsBetween(0, Window.unboundedFollowing))}
    )
    met = (F.col("code") == F.col("of")) & (F.col("_part") == F.col("at"))
    return placed.where(~F.col("all_right")).join(edges, met).select("code", "size", F.coalesce("below", "before").alias("below"), F.coalesce("above", "after").alias("above"))


def wanted(left: DataFrame, right: DataFrame) -> DataFrame:
    """code, size, kind, at, penalty: where the right products at the least difference from each (code, size) of the left side stand."""
    sized = left.where("size is not null").select("code", "size", F.lit(False).alias("right")).unionByName(right.where("size is not null").select("code", "size", F.lit(True).alias("right")))
    near = neighbours(sized.distinct())
    bare = right.where("size is null").select(F.col("code").alias("bare")).distinct()
    near = near.join(bare, F.col("code") == F.col("bare"), "left")
    gap = lambda c: F.abs(F.col("size") - F.col(c))
    least = F.least(gap("below"), gap("above"), F.when(F.col("bare").isNotNull(), F.lit(NO_SIZE)))
    place = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.cast("double").alias("at"))
    places = F.array(
        F.when(gap("below") == least, place(SIZED, F.col("below"))), F.when((gap("above") == least) & (F.col("above") != F.coalesce("below", F.col("above") + 1)), place(SIZED, F.col("above"))),
        F.when(F.col("bare").isNotNull() & (least == NO_SIZE), place(UNSIZED, F.lit(0.0))),
    )
    some = near.select("code", "size", least.alias("penalty"), F.explode(F.array_compact(places)).alias("p")).select("code", "size", "p.kind", "p.at", "penalty")
    none = left.where("size is null").select("code", "size", F.lit(ALL).alias("kind"), F.lit(0.0).alias("at"), F.lit(NO_SIZE).alias("penalty")).distinct()
    return some.unionByName(none)


def _blocks(left: DataFrame, right: DataFrame) -> DataFrame:
    """code, size, bag, b_id, overlap: the best of each left bag within each block of right bags."""
    schema = f"code string, size double, bag string, b_id {right.schema['b_id'].dataType.simpleString()}, overlap int"

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("code", "size", "bag", "b_id", "overlap")}
        if x.num_rows and y.num_rows:
            y = y.sort_by("b_id")
            words = [b.split() for b in y.column("bag").to_pylist()]
            number = {w: k for k, w in enumerate(sorted({w for b in words for w in b}))}
            word = np.array([number[w] for b in words for w in b], np.int64)
            owner = np.repeat(np.arange(len(words)), [len(b) for b in words])
            order = np.argsort(word, kind="stable")
            owner, edge = owner[order], np.searchsorted(word[order], np.arange(len(number) + 1))
            ids = y.column("b_id").to_pylist()
            for code, size, b in zip(*[x.column(c).to_pylist() for c in ("code", "size", "bag")]):
                lists = [owner[edge[k] : edge[k + 1]] for k in (number.get(w) for w in b.split()) if k is not None]
                shared = np.bincount(np.concatenate(lists), minlength=len(ids)) if lists else np.zeros(len(ids), np.int64)
                at = int(shared.argmax())  # the first of the largest: the least id
                for c, v in zip(out, (code, size, b, ids[at], int(shared[at]))):
                    out[c].append(v)
        types = (pa.string(), pa.float64(), pa.string(), y.schema.field("b_id").type, pa.int32())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    keys = ("code", "kind", "at", "row_block", "column_block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def nearest(a: DataFrame, b: DataFrame, few: int = FEW, left_block: int = LEFT_BLOCK, right_block: int = RIGHT_BLOCK) -> DataFrame:
    """a_bb_id, b_bb_id, upc_clean, size_penalty, title_overlap: the best for each row of (id, code, size, title) of the left side.

    Left products whose code no right one has drop out. Differences are those of double precision: right sizes that only rounding makes equally near count as the nearest of them.
    """
    shape = lambda df: df.where(F.col("code").isNotNull()).select("id", "code", "size", bag(F.col("title")).alias("bag"))
    products, others = written(shape(a)), shape(b)
    right = written(others.groupBy("code", "size", "bag").agg(F.min("id").alias("b_id")))
    codes = right.select(F.col("code").alias("of")).distinct()
    left = written(products.select("code", "size", "bag").distinct().join(codes, F.col("code") == F.col("of"), "left_semi"))
    places = written(wanted(left, right))
    stands = right.select("code", F.when(F.col("size").isNull(), UNSIZED).otherwise(SIZED).alias("kind"), F.coalesce("size", F.lit(0.0)).alias("at"), "bag", "b_id")
    open_ = places.where(F.col("kind") == ALL).select(F.col("code").alias("of")).distinct()
    every = right.join(open_, F.col("code") == F.col("of"), "left_semi").groupBy("code", "bag").agg(F.min("b_id").alias("b_id"))
    stands = written(stands.unionByName(every.select("code", F.lit(ALL).alias("kind"), F.lit(0.0).alias("at"), "bag", "b_id")))
    asked = left.alias("l").join(places.alias("p"), (F.col("l.code") == F.col("p.code")) & F.col("l.size").eqNullSafe(F.col("p.size"))).select("l.code", "l.size", "l.bag", "p.kind", "p.at")
    at = ["code", "kind", "at"]
    many = written(stands.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > few))
    overlap = F.size(F.array_intersect(F.filter(F.split("bag", " "), lambda w: w != ""), F.filter(F.split("b_bag", " "), lambda w: w != "")))
    light = asked.join(many.select(*at), at, "left_anti").join(stands.withColumnRenamed("bag", "b_bag"), at)
    found = light.select("code", "size", "bag", "b_id", overlap.alias("overlap"))
    if many.take(1):
        heavy = written(asked.join(many.select(*at), at))
        rows = heavy.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / left_block).alias("rows"))
        grid = written(many.select(*at, F.ceil(F.col("n") / right_block).alias("columns")).join(rows, at))
        cell = lambda n: F.pmod(F.xxhash64("bag"), F.col(n))
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        x = heavy.join(grid, at).withColumn("row_block", cell("rows")).withColumn("column_block", upto("columns"))
        y = stands.join(grid, at).withColumn("column_block", cell("columns")).withColumn("row_block", upto("rows"))
        found = found.unionByName(_blocks(x.drop("rows", "columns"), y.drop("rows", "columns")))
    key = ["code", "size", "bag"]
    best = found.groupBy(*key).agg(F.max("overlap").alias("overlap"), F.min_by("b_id", F.struct(-F.col("overlap"), F.col("b_id"))).alias("b_id"))
    gaps = places.groupBy("code", "size").agg(F.first("penalty").alias("penalty"))
    sized = lambda y: (F.col("x.code") == F.col(f"{y}.code")) & F.col("x.size").eqNullSafe(F.col(f"{y}.size"))
    out = products.alias("x").join(best.alias("y"), sized("y") & (F.col("x.bag") == F.col("y.bag"))).join(gaps.alias("z"), sized("z"))
    return out.select(F.col("x.id").alias("a_bb_id"), F.col("y.b_id").alias("b_bb_id"), F.col("x.code").alias("upc_clean"), F.col("z.penalty").alias("size_penalty"), F.col("y.overlap").alias("title_overlap"))


def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """All pairs of a code, of (id, code, size, title) on both sides."""
    x, y = a.alias("x"), b.alias("y")
    penalty = F.coalesce(F.abs(F.col("x.size") - F.col("y.size")), F.lit(NO_SIZE))
    overlap = text.title_overlap(F.col("x.title"), F.col("y.title"))
    met = x.join(y, F.col("x.code") == F.col("y.code"))
    return met.select(F.col("x.id").alias("a_bb_id"), F.col("y.id").alias("b_bb_id"), F.col("x.code").alias("upc_clean"), penalty.alias("size_penalty"), overlap.alias("title_overlap"))


def best(a: DataFrame, b: DataFrame, few: int = FEW) -> DataFrame:
    """a_bb_id, b_bb_id, upc_clean, size_penalty, title_overlap: the best right product of each left id that has one."""
    hot = b.where(F.col("code").isNotNull()).groupBy(F.col("code").alias("hot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > few).select("hot")
    if hot.take(1):  # this reads codes alone
        hot, right, is_hot = written(hot), written(b), F.col("code") == F.col("hot")
        found = pairs(a.join(hot, is_hot, "left_anti"), right.join(hot, is_hot, "left_anti"))
        found = found.unionByName(nearest(a.join(hot, is_hot, "left_semi"), right.join(hot, is_hot, "left_semi"), few))
    else:
        found = pairs(a, b)
    order = F.struct(F.col("size_penalty"), -F.col("title_overlap"), F.col("b_bb_id"))
    rest = F.struct("b_bb_id", "upc_clean", "size_penalty", "title_overlap")
    return found.groupBy("a_bb_id").agg(F.min_by(rest, order).alias("r")).select("a_bb_id", "r.*")
