"""Operators that replace one-task plans: numbering, order statistics, nearest vectors by tiles, code matches, the funnel."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchwright.functions import vectors
from matchwright.operators import codes, matching, nearest, numbering, order_stats


def plans_text(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("block", [2, 4096])
def test_running_sums(spark, block):
    rng = random.Random(1)
    rows = [(g, o, rng.choice([None, 1, 2, 5]), 1) for g in ("a", None, "b") for o in range(0, 37, 1 if g else 3)]
    df = spark.createDataFrame(rows, "g string, o long, n long, m long")
    got = {(r.g, r.o): (r.s, r.t) for r in numbering.running_sums(df, "o", {"s": "n", "t": "m"}, 37, ("g",), block).collect()}
    assert got == {(g, o): (sum(n or 0 for h, p, n, _ in rows if h == g and p < o), sum(h == g and p < o for h, p, _, _ in rows)) for g, o, _, _ in rows}


@pytest.mark.parametrize("carried", [1_000_000, 0])
def test_row_index(spark, carried):
    rng = random.Random(2)
    rows = [(rng.randrange(10_000), str(k)) for k in range(3000)] + [(None, "x"), (5, None), (5, None)]
    df = spark.createDataFrame(rows, "a long, b string").repartition(9)
    out = numbering.row_index(df, "a", "b", carried=carried)
    got = sorted((r.row_index, r.a, r.b) for r in out.collect())
    assert [g[0] for g in got] == list(range(len(rows)))
    lowest = lambda v: (v is not None, v)
    assert [g[1:] for g in got] == sorted(rows, key=lambda r: (lowest(r[0]), lowest(r[1])))
    assert numbering.row_index(df.limit(0), "a").count() == 0


def test_summary_of_hot_values(spark):
    """Most values are equal; the others are spread, some null. Equal to numpy, and nothing holds a key's values."""
    rng = np.random.default_rng(3)
    x = {"hot": np.where(rng.random(5000) < 0.8, 1.0, rng.normal(size=5000)), "one": np.array([2.5]), "two": np.array([1.0, 4.0]), "wide": rng.normal(size=3001)}
    rows = [(k, float(v)) for k, vs in x.items() for v in vs] + [("hot", None), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: r for r in order_stats.summary(df, "k", "v", (0.1, 0.25, 0.5, 0.75)).collect()}
    assert set(got) == {*x, "none", None}
    for k, v in x.items():
        r = got[k]
        assert r["count"] == len(v) and np.allclose([r.mean, r["min"], r["max"]], [v.mean(), v.min(), v.max()])
        assert np.allclose([r.p10, r.p25, r.p50, r.p75], np.percentile(v, [10, 25, 50, 75]))
        assert r["std"] is None if len(v) == 1 else np.isclose(r["std"], v.std(ddof=1))
    assert got["none"]["count"] == 0 and got["none"].p50 is None and got[None].p50 == 1.0
    assert order_stats.summary(df.limit(0), "k", "v").count() == 0


KIND = "bb_id long, embedding array<double>"


def brute(a, b, k):
    """(a_id, rank) -> (b_id, cosine), by the definition."""
    norm = lambda v: v / np.linalg.norm(v) if np.linalg.norm(v) else v
    out = {}
    for i, x in a:
        found = sorted((-round(float(norm(x) @ norm(y)), 9), j) for j, y in b)[:k]
        out |= {(i, r): (j, -s) for r, (s, j) in enumerate(found, 1)}
    return out


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, None if v is None else list(map(float, v))) for i, v in rows], KIND).repartition(parts)


def shown(df):
    return {(r.a_id, r["rank"]): (r.b_id, round(r.similarity, 9)) for r in df.collect()}


def points(n, d, start, seed, centres=6):
    """Vectors around a few directions, far apart enough for tiles to differ."""
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(0).normal(size=(centres, d))
    return [(start + k, middle[k % centres] + 0.15 * rng.normal(size=d)) for k in range(n)]


@pytest.mark.parametrize("k,tile", [(1, 600), (7, 2000), (500, 3000)])
def test_tiled_search_is_exact(spark, k, tile):
    a, b = points(60, 6, 0, 1), points(240, 6, 1000, 2)
    a += [(900, np.zeros(6)), (901, -a[0][1])]
    b += [(5000 + i, b[3][1]) for i in range(40)] + [(6000, np.zeros(6)), (6001, np.zeros(6)), (6002, -b[5][1])]  # copies, zero vectors
    want = brute(a, b, k)
    assert shown(nearest.topk(frame(spark, a), frame(spark, b), k)) == want
    assert shown(nearest.topk(frame(spark, a), frame(spark, b), k, carried=0, tile=tile)) == want


def test_many_left_few_right(spark):
    """|A| far above |B|: the left side is cut into blocks, by its own bytes."""
    a, b = points(3000, 3, 0, 4), points(30, 3, 100_000, 5)
    assert shown(nearest.topk(frame(spark, a, 8), frame(spark, b), 3, carried=0, tile=240)) == brute(a, b, 3)


def test_far_tiles_are_skipped():
    rng = np.random.default_rng(1)
    c = nearest.unit(rng.normal(size=(5, 8)))
    v = nearest.unit(np.repeat(c, 50, axis=0) + 0.05 * rng.normal(size=(250, 8)))
    low = np.array([(v[50 * t : 50 * t + 50] @ c[t]).min() for t in range(5)])
    most = nearest.bounds(v, c, low, np.zeros(5, bool))
    for t in range(5):
        assert (most[:, t] >= (v @ v[50 * t : 50 * t + 50].T).max(axis=1)).all()
    assert (most < 0.9).mean() > 0.7  # while neighbours are nearer than that
    assert (nearest.bounds(-c[:1], c[:1], low[:1], np.array([True])) >= 0).all()


@pytest.mark.parametrize("carried", [8_000_000, 0])
def test_unsound_vectors_take_no_part(spark, carried):
    a = [(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0])]
    b = [(11, [1.0, 0.1]), (12, [float("nan"), 0.0]), (13, None), (14, [0.0, 1.0]), (15, [1.0]), (16, [-1.0, 0.0]), (17, [1.0, 2.0, 3.0])]
    left = frame(spark, a).union(spark.createDataFrame([(5, [0.0, None])], KIND))
    got = nearest.topk(left, frame(spark, b), 2, carried=carried)
    assert sorted((r.a_id, r.b_id, r["rank"]) for r in got.collect()) == [(1, 11, 1), (1, 14, 2)]
    assert sorted(r.b_id for r in nearest.topk(left, frame(spark, b), 2, carried=carried, dimension=1).collect()) == [15]
    with pytest.raises(ValueError, match="another length"):
        nearest.topk(left, frame(spark, b), 2, strict=True)


def test_nearest_of_nothing(spark):
    a, b = frame(spark, points(5, 3, 0, 1)), frame(spark, points(5, 3, 10, 1))
    for carried in (nearest.CARRIED, 0):
        assert nearest.topk(a, b.limit(0), 5, carried=carried).count() == 0
        assert nearest.topk(a.limit(0), b, 5, carried=carried).count() == 0


def test_search_equals_built_in_functions(spark):
    a, b = points(20, 4, 0, 7), points(50, 4, 100, 8)
    x = frame(spark, a).select(F.col("bb_id").alias("a_id"), vectors.l2_normalize(F.col("embedding")).alias("x"))
    y = frame(spark, b).select(F.col("bb_id").alias("b_id"), vectors.l2_normalize(F.col("embedding")).alias("y"))
    pairs = x.crossJoin(y).select("a_id", "b_id", vectors.dot(F.col("x"), F.col("y")).alias("similarity"))
    assert shown(nearest.ranked(pairs, 5)) == shown(nearest.topk(frame(spark, a), frame(spark, b), 5))


PRODUCT = "bb_id long, upc_clean_l0 string, is_private_label boolean, title_normalized_l0 string, size_ml_final double"


def best_by_code(a, b):
    """By the definition: all pairs of a code."""
    out = []
    for i, code, _, title, size in a:
        found = [
            (9999.0 if size is None or s is None else abs(size - s), -len(set((title or "").split()) & set((t or "").split())), j)
            for j, c, _, t, s in b if c == code
        ]
        if found:
            out.append((i, min(found)[2], code))
    return sorted(out)


def penalty(a, b, found):
    size = {r[0]: r[4] for r in (*a, *b)}
    bag = {r[0]: set((r[3] or "").split()) for r in (*a, *b)}
    return [(9999.0 if size[i] is None or size[j] is None else abs(size[i] - size[j]), len(bag[i] & bag[j])) for i, j, _ in found]


def products(n, start, seed, codes_=5, sizes_=12):
    rng = random.Random(seed)
    words = "green tea milk bar soap oat corn rice salt lime".split()
    size = lambda: rng.choice([None, 20_000.0, -9_000.0, *range(sizes_)])
    return [(start + k, str(rng.choice([0, 0, 0, *range(codes_)])), False, rng.choice([None, "", " ".join(rng.sample(words, rng.randint(1, 4)))]), None if (s := size()) is None else float(s)) for k in range(n)]


@pytest.mark.parametrize("few,left,right", [(32, 4000, 20_000), (0, 7, 5), (2, 50, 3)])
def test_nearest_by_code(spark, few, left, right):
    a, b = products(300, 0, 1), products(200, 1000, 2) + [(5000, "9", False, "x", 1.0)]
    a += [(900, "7", False, "x", 1.0), (901, "9", False, "x", None), (902, "9", False, "x", 30_000.0)]
    shape = lambda rows: spark.createDataFrame(rows, PRODUCT).repartition(5).select(F.col("bb_id").alias("id"), F.col("upc_clean_l0").alias("code"), F.col("size_ml_final").alias("size"), F.col("title_normalized_l0").alias("title"))
    want = best_by_code(a, b)
    got = sorted(tuple(r) for r in codes.nearest(shape(a), shape(b), few, left, right).collect())
    assert [r[:3] for r in got] == want and [r[3:] for r in got] == penalty(a, b, want)
    for bound in (10, 1000):  # some codes, or none, count as hot
        assert sorted(tuple(r) for r in codes.best(shape(a + a[:9]), shape(b), bound).collect()) == got


def test_code_without_partners(spark):
    a = spark.createDataFrame([(1, "1", False, "x", 1.0)], PRODUCT)
    assert matching.upc_exact(a, a.limit(0)).count() == 0 and matching.upc_exact(a.limit(0), a).count() == 0
    assert matching.upc_exact(a, a.withColumn("is_private_label", F.lit(True))).count() == 0


def test_hot_code(spark):
    """One code with 20,000 products on each side: some 10^8 pairs that nobody makes."""
    make = lambda n, add: spark.range(n).select((F.col("id") + add).alias("bb_id"), F.lit("7").alias("upc_clean_l0"), F.lit(False).alias("is_private_label"), F.concat(F.lit("tea "), (F.col("id") % 50).cast("string")).alias("title_normalized_l0"), (F.col("id") % 400).cast("double").alias("size_ml_final"))
    got = matching.upc_exact(make(20_000, 0), make(20_000, 100_000))
    want = got.where(F.col("b_bb_id") == 100_000 + F.col("a_bb_id") % 400).count()
    assert got.count() == want == 20_000
