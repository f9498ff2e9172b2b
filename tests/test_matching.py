import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchwright.functions import features, sizes, vectors
from matchwright.operators import matching
from matchwright.plans import pipeline, registry
from matchwright.plans.policy import FIXTURE, Policy
from matchwright.sources import clients


def sides(spark, n_a=23, n_b=40, d=5, seed=1):
    rng = np.random.default_rng(seed)
    make = lambda n, start: spark.createDataFrame([(start + k, rng.integers(-3, 4, d).astype(float).tolist()) for k in range(n)], "bb_id long, embedding array<double>")
    return make(n_a, 0), make(n_b, 1000)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    r = df.select(vectors.l2_normalize(F.col("a")).alias("u"), vectors.l2_normalize(F.col("z")).alias("n"), vectors.cosine(F.col("a"), F.col("a")).alias("c"), vectors.cosine(F.col("a"), F.col("z")).alias("o")).first()
    assert r.u == [0.6, 0.8] and r.n == [0.0, 0.0] and r.c == 1.0 and r.o == 0.0


@pytest.mark.parametrize(
    "a,b,soft,strict",
    [
        (100.0, 105.0, 1.0, 1.0), (100.0, 105.1, 1.0, 0.0), (100.0, 125.0, 1.0, 0.0), (100.0, 125.1, 0.7, 0.0), (100.0, 150.0, 0.7, 0.0), (100.0, 150.1, 0.4, 0.0),
        (100.0, 200.0, 0.4, 0.0), (200.1, 100.0, 0.0, 0.0), (0.0, 1.0, 0.0, 0.0), (-1.0, -1.0, 0.0, 0.0), (None, 1.0, 0.0, 0.0), (None, None, 0.0, 0.0),
    ],
)
def test_size_ratios(spark, a, b, soft, strict):
    r = spark.createDataFrame([(a, b)], "a double, b double").select(sizes.size_similarity(F.col("a"), F.col("b")).alias("x"), sizes.size_strict(F.col("a"), F.col("b")).alias("y")).first()
    assert (r.x, r.y) == (soft, strict)


def test_sizes_meet_in_a_common_dimension(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, None, 4.0, 3.0), (1.0, None, None, None, 4.0, None)], "am double, ag double, an double, bm double, bg double, bn double")
    p = sizes.size_pair({"ml": F.col("am"), "g": F.col("ag"), "count": F.col("an")}, {"ml": F.col("bm"), "g": F.col("bg"), "count": F.col("bn")})
    assert [tuple(r.p) for r in df.select(p.alias("p")).collect()] == [(2.0, 4.0), (None, None)]


def test_text_features(spark):
    df = spark.createDataFrame([(" Acme", "acme "), ("", ""), ("UNKNOWN", "unknown"), (None, "a")], "a string, b string")
    assert [r.x for r in df.select(features.same_text(F.col("a"), F.col("b")).alias("x")).collect()] == [1.0, 0.0, 1.0, 0.0]
    assert [r.x for r in spark.createDataFrame([(1.5,), (-1.0,), (0.3,), (None,)], "v double").select(features.clamped(F.col("v")).alias("x")).collect()] == [1.0, 0.0, 0.3, None]


def test_thresholds_in_single_precision(spark):
    below = [float(np.nextafter(np.float32(t), np.float32(0))) for t in (0.70, 0.65)]
    cases = [(0.70, 0.65, 1.0, 0.0, True), (below[0], 0.65, 1.0, 0.0, False), (0.70, below[1], 1.0, 0.0, False), (0.65, 0.60, 1.0, 1.0, True), (0.65, 0.60, 1.0, 0.0, False), (0.9, 0.9, 0.0, 1.0, False), (None, 0.9, 1.0, 1.0, False)]
    df = spark.createDataFrame([c[:4] for c in cases], "score_total float, feature_embedding float, feature_category float, feature_size_strict float")
    assert [r.x for r in df.select(matching.accepted(Policy()).alias("x")).collect()] == [c[4] for c in cases]
    band = spark.createDataFrame([(k, v) for k, v in enumerate((0.70, below[0], 0.71, 0.705))], "a_id long, score_total float")
    assert rows(matching.review_band(band, Policy()), "a_id") == [(0,), (3,)]
    assert matching.review_band(band, Policy(band_limit=1)).count() == 1


def scored(spark, items):
    cols = "a_id long, b_id long, rank int, score_total float, feature_embedding float, feature_category float, feature_size_strict float, feature_brand float, feature_size float"
    return spark.createDataFrame([(a, b, r, s, e, 1.0, 0.0, 0.0, 0.0) for a, b, r, s, e in items], cols)


def test_best_first_then_the_rule(spark):
    """A product whose best pair fails has no match here, and its runner-up in the earlier path."""
    df = scored(spark, [(1, 10, 1, 0.95, 0.1), (1, 11, 2, 0.9, 0.9), (2, 12, 2, 0.8, 0.9), (2, 13, 1, 0.8, 0.9), (None, 5, 1, 0.99, 0.99)])
    assert rows(matching.best_per_a(df), "a_id", "b_id") == [(1, 10), (2, 13)]
    assert rows(matching.matches(df), "a_id", "b_id") == [(2, 13)]
    old = spark.createDataFrame([(1, 10, 0.95, 0.4, 0.4, 0.5, 0.0, 0.0, 1.0), (1, 11, 0.9, 0.9, 0.9, 0.0, 0.0, 0.0, 0.05), (2, 12, 0.9, 0.9, 0.9, 0.09, 0.0, 0.0, 0.0)], "bb_id_A long, bb_id_B long, weighted_score double, sim_embedding double, sim_embedding_01 double, title_token_overlap double, brand_match_score double, size_ratio double, category_soft_match double")
    out = matching.legacy_select(old)
    assert rows(out, "bb_id_A", "bb_id_B") == [(1, 11)] and len(out.columns) == 8
    assert len(matching.legacy_select(old.limit(0)).columns) == 8


def test_scores_do_not_depend_on_row_order(spark):
    items = [(a, b, r, round(0.7 + ((a * 7 + b * 3) % 5) / 20, 2), 0.9) for a in range(12) for r, b in enumerate(range(20, 26), 1)]
    want = rows(matching.matches(scored(spark, items)), "a_id", "b_id")
    assert rows(matching.matches(scored(spark, items[::-1]).repartition(5)), "a_id", "b_id") == want and len({a for a, _ in want}) == len(want)


def test_weighted_score(spark):
    cols = "a_id long, b_id long, similarity double, a_brand_final string, b_brand_final string, a_category_lvl1_final string, b_category_lvl1_final string, a_size_ml_final double, b_size_ml_final double"
    df = spark.createDataFrame([(1, 2, 1.2, "x", "X", "a", "b", 100.0, 140.0), (1, 3, None, None, None, "a", "a", 1.0, None)], cols)
    got = {r.b_id: r for r in matching.score(df, Policy(number="double")).collect()}
    assert abs(got[2].score_total - (0.55 + 0.15 + 0.05 * 0.7)) < 1e-12
    assert got[3].feature_embedding is None and got[3].score_total is None and got[3].feature_size == 0.0
    assert dict(matching.score(df).dtypes)["score_total"] == "float"


def test_codes(spark):
    cols = "bb_id long, upc_clean_l0 string, is_private_label boolean, title_normalized_l0 string, size_ml_final double, size_g_final double"
    a = spark.createDataFrame([(1, "9", False, "green tea", 100.0, None), (2, "9", None, "x", None, None), (3, "", False, "x", None, None), (4, "8", False, "", None, None)], cols)
    b = spark.createDataFrame([(10, "9", False, "tea", None, 90.0), (11, "9", False, "green tea", None, 110.0), (12, "9", False, "green tea", None, 110.0), (13, "9", True, "t", None, None), (14, "8", False, "", None, None)], cols)
    pairs = matching.upc_join(a, b)
    assert rows(pairs, "a_bb_id", "b_bb_id", "size_penalty", "title_overlap") == [(1, 10, 10.0, 1), (1, 11, 10.0, 2), (1, 12, 10.0, 2), (4, 14, 9999.0, 0)]
    assert rows(matching.upc_exact(a, b), "a_bb_id", "b_bb_id", "upc_clean", "match_type") == [(1, 11, "9", "upc_exact"), (4, 14, "8", "upc_exact")]
    assert rows(matching.upc_join(a.select("bb_id", "upc_clean_l0", "is_private_label", F.col("title_normalized_l0").alias("name")), b), "size_penalty")[0] == (9999.0,)


REPLIES = {
    '{"label":"EXACT","score":1.5}': ("exact", 1.0), '{"label":"exact","score":"0.9"}': ("exact", 0.9), '{"label":"exact"}': ("exact", 0.0), '{"label":"exact","score":null}': ("none", 0.0),
    '{"label":"exact ","score":0.5}': ("none", 0.5), '{"score":0.5}': ("none", 0.5), '{"label":"none","score":-3}': ("none", 0.0), "[1]": ("none", 0.0), "not json": ("none", 0.0), None: ("none", 0.0),
    '{"label":"exact","score":"5d"}': ("none", 0.0), '{"label":"substitute","score":"x"}': ("none", 0.0),
}


def test_review_replies(spark):
    df = spark.createDataFrame([(k,) for k in REPLIES], "reply string")
    assert {r.reply: (r.gpt_label, r.gpt_score) for r in matching.review_decode(df).collect()} == REPLIES
    assert {r.reply: (r.gpt_label, r.gpt_score) for r in matching.review_decode_native(df).collect()} == REPLIES
    for odd in ("{'label':'exact'}", '{"label":"exact"} tail', '{"label":"exact","score":NaN}'):
        assert matching.decode_review(odd) == (("exact", 1.0) if "NaN" in odd else ("none", 0.0))


def test_every_pair_of_the_band_is_reviewed(spark, monkeypatch):
    """The band's limit is that of review_band: the stub answers to all pairs of the band, and to those alone."""
    n = FIXTURE.band_limit + 500
    low, high = FIXTURE.band
    score = F.when(F.col("id") < n, F.lit(low) + F.col("id") % 7 / 100).otherwise(F.when(F.col("id") == n, F.lit(high)).when(F.col("id") == n + 1, F.lit(low - 0.01)))
    kept = spark.range(n + 3).select((F.col("id") * 2).alias("a_id"), (F.col("id") * 2 + 1).alias("b_id"), score.alias("score_total"))
    monkeypatch.setattr(registry, "kept", lambda *_: kept)
    want = [(r.a_id, r.b_id, *matching.decode_review(r.reply)) for r in registry.with_reply(kept.where(F.col("a_id") < 2 * n)).collect()]
    assert rows(registry.llm_review_stub(spark, ""), "a_id", "b_id", "gpt_label", "gpt_score") == sorted(want) and len(want) == n
    assert registry.review_band(spark, "").count() == FIXTURE.band_limit


def test_final(spark):
    kept = scored(spark, [(1, 10, 1, 0.9, 0.9), (2, 11, 1, 0.9, 0.9), (3, 12, 1, 0.9, 0.9)])
    review = spark.createDataFrame([(1, 10, "none"), (2, 99, "none"), (3, 12, "exact")], "a_id long, b_id long, gpt_label string")
    out = matching.final_matches(kept, review)
    assert rows(out, "bb_id_A", "bb_id_B") == [(2, 11), (3, 12)]
    assert matching.final_pairs(out.union(out)).count() == 2
    blended = matching.blended(spark.createDataFrame([(0.5, 1.0)], "score_total double, gpt_score double")).first()
    assert abs(blended.final_score - 0.7) < 1e-12


def test_sample_and_summary(spark):
    df = scored(spark, [(k, k, 1, 0.5 + k / 1000, 0.9) for k in range(200)])
    one, two = (rows(matching.sample(x, Policy()), "a_id") for x in (df, df.repartition(7)))
    assert one == two and len(one) == 50 and matching.sample(df.limit(3)).count() == 3 and matching.sample(df.limit(0)).count() == 0
    s = {r.feature: r for r in matching.feature_summary(df).collect()}["score_total"]
    x = np.array([np.float32(0.5 + k / 1000) for k in range(200)], float)
    assert s["count"] == 200 and np.allclose([s.mean, s["std"], s["min"], s.p25, s.p50, s.p75, s["max"]], [x.mean(), x.std(ddof=1), x.min(), *np.percentile(x, [25, 50, 75]), x.max()])
    passing = sum(np.float32(0.5 + k / 1000) >= np.float32(0.70) for k in range(200))
    some = df.union(df.withColumn("rank", F.lit(2)).limit(7)).union(df.limit(1).withColumn("a_id", F.lit(None).cast("long")))
    assert matching.coverage(some).first().asDict() == {"n_a": 200, "n_matched": 0}
    sure = df.withColumn("feature_embedding", F.lit(0.9).cast("float"))
    assert matching.coverage(sure).first().asDict() == {"n_a": 200, "n_matched": passing}
    assert rows(matching.funnel(sure), "step", "n", "n_missing") == [("best", 200, 0), ("candidates", 200, 0), ("matches", passing, 0)]
    assert rows(matching.funnel(some), "step", "n") == [("best", 200), ("candidates", 208), ("matches", 0)]
    assert rows(matching.funnel(df.limit(0)), "n", "n_missing") == [(0, 0)] * 3


def test_without_review_all_matches_are_final(spark):
    a, b = sides(spark, 6, 6)
    add = lambda df: df.withColumns({"brand_final": F.lit("x"), "category_lvl1_final": F.lit("c"), "size_ml_final": F.lit(1.0)})
    plain = pipeline.match(add(a), add(b), FIXTURE)
    none = pipeline.match(add(a), add(b), FIXTURE, lambda band: band.withColumn("gpt_label", F.lit("exact")))
    assert rows(plain, "bb_id_A", "bb_id_B") == rows(none, "bb_id_A", "bb_id_B") != []


def test_named_encoder(monkeypatch):
    calls = []

    class Model:
        def __init__(self, name):
            calls.append(name)

        def encode(self, texts, batch_size, show_progress_bar):
            calls.append(batch_size)
            return [[float(len(t))] for t in texts]

    monkeypatch.setitem(sys.modules, "sentence_transformers", types.SimpleNamespace(SentenceTransformer=Model))
    encode = clients.sentence_encoder("small", 8)()
    assert encode(["a", "bcd"]).tolist() == [[1.0], [3.0]] and clients.sentence_encoder("small", 8)()([]).shape == (0, 0)
    assert calls == ["small", 8]
