"""Every operator as a query over the fixture catalog: (session, folder) -> DataFrame."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.functions import features, sizes, taxonomy, text
from matchwright.functions import vectors as vec
from matchwright.operators import cleaning, matching, nearest, numbering
from matchwright.operators import codes as product_codes
from matchwright.operators.staging import shared_folder, written
from matchwright.plans import pipeline, runner
from matchwright.plans.policy import FIXTURE, CatalogConfig
from matchwright.sources import clients, fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KINDS = ("ml", "g", "count")
c = F.col


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def r6(x: Column) -> Column:
    return F.round(x.cast("double"), 6)


def halves(similarity: Column) -> Column:
    return (F.lit(1.0) + similarity) / 2


# ---- stages


def raw(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.catalog(spark, d)


def l0(spark: SparkSession, d: str) -> DataFrame:
    """Both sides are cleaned alike; the fixture already carries its side."""
    x = raw(spark, d).withColumnRenamed("side", "_side")
    return cleaning.l0_clean(x, CatalogConfig("A")).withColumn("side", c("_side")).drop("_side")


def l1(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.l1_clean(l0(spark, d), fixtures.clean_replies(spark, d))


def l2(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.l2_clean(l1(spark, d))


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = l2(spark, d).join(fixtures.vectors(spark, d), c("bb_id") == c("vec_id")).drop("vec_id")
    return x.where("side = 'A'"), x.where("side = 'B'")


def vector_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = raw(spark, d).select("bb_id", "side").join(fixtures.vectors(spark, d), c("bb_id") == c("vec_id")).drop("vec_id")
    return x.where("side = 'A'"), x.where("side = 'B'")


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.candidates(*sides(spark, d), FIXTURE, halves)


def kept(spark: SparkSession, d: str) -> DataFrame:
    return matching.matches(candidates(spark, d), FIXTURE)


def with_reply(band: DataFrame) -> DataFrame:
    return band.withColumn("reply", F.expr(fixtures.REVIEW_REPLY_SQL.format(key=fixtures.PAIR_KEY)))


def reviewed(band: DataFrame) -> DataFrame:
    return matching.review_decode(with_reply(band))


def attributed(spark: SparkSession, d: str) -> DataFrame:
    a, b = sides(spark, d)
    return matching.attach(matching.topk(a, b, FIXTURE.k).withColumn("similarity", halves(c("similarity"))), a, b)


# ---- sources and scalar functions


@query
def scan_catalog(spark: SparkSession, d: str) -> DataFrame:
    return raw(spark, d)


@query
def normalize_title(spark: SparkSession, d: str) -> DataFrame:
    return raw(spark, d).select("bb_id", text.normalize_title(c("name")).alias("title"))


@query
def clean_upc(spark: SparkSession, d: str) -> DataFrame:
    u = text.clean_upc(c("upc_raw"))
    return raw(spark, d).select("bb_id", u.alias("upc"), u.isNotNull().alias("has_upc"))


@query
def parse_size(spark: SparkSession, d: str) -> DataFrame:
    t = text.normalize_title(c("name"))
    return raw(spark, d).select("bb_id", sizes.parsed_value(t).alias("value"), sizes.parsed_unit(t).alias("unit"))


@query
def normalize_size(spark: SparkSession, d: str) -> DataFrame:
    v, u = c("value"), c("unit")
    return parse_size(spark, d).select("bb_id", *[r6(sizes.normalized_size(v, u, k)).alias(k) for k in KINDS], sizes.normalized_unit(u).alias("kind"))


@query
def map_department(spark: SparkSession, d: str) -> DataFrame:
    return raw(spark, d).select("bb_id", taxonomy.map_department(c("department")).alias("category"))


@query
def is_blank(spark: SparkSession, d: str) -> DataFrame:
    return raw(spark, d).select("bb_id", text.is_blank(c("brand_raw")).alias("brand_blank"), text.is_blank(c("department")).alias("department_blank"))


# ---- phase one

L0_OUT = ["bb_id", "side", "name", "upc_raw", "brand_raw", "department", "is_private_label", "title_raw", "title_normalized_l0", "upc_clean_l0", "has_upc_l0", "category_raw", "size_value_raw_l0", "size_unit_raw_l0", "size_unit_norm_l0", "product_id"]
L0_SIZE = ["size_ml_l0", "size_g_l0", "size_count_l0"]
L1_TEXT = ["brand", "brand_confidence", "is_private_label_llm", "product_core", "product_core_confidence", "flavor", "flavor_confidence", "category_lvl1", "category_lvl1_confidence", "category_lvl2", "category_lvl2_confidence", "notes", "size_confidence"]
L1_SIZE = ["size_ml", "size_g", "size_count"]
FINAL_TEXT = ["brand_final", "brand_final_source", "product_core_final", "product_core_final_source", "flavor_final", "flavor_final_source", "category_lvl1_final", "category_lvl2_final", "category_final_source", "size_final_source"]
FINAL_SIZE = ["size_ml_final", "size_g_final", "size_count_final"]


def out(df: DataFrame, plain: list[str], numbers: list[str]) -> DataFrame:
    return df.select(*plain, *[r6(c(n)).alias(n) for n in numbers])


@query
def l0_clean(spark: SparkSession, d: str) -> DataFrame:
    return out(l0(spark, d), L0_OUT, L0_SIZE)


@query
def l1_route(spark: SparkSession, d: str) -> DataFrame:
    x = l0(spark, d)
    return x.select("bb_id", cleaning.needs_model(x).alias("hard"))


@query
def l1_route_counts(spark: SparkSession, d: str) -> DataFrame:
    return l1_route(spark, d).groupBy("hard").agg(F.count(F.lit(1)).alias("n"))


@query
def l1_limit(spark: SparkSession, d: str) -> DataFrame:
    return l0(spark, d).orderBy("bb_id").limit(100).select("bb_id", "title_normalized_l0")


@query
def l1_fallback(spark: SparkSession, d: str) -> DataFrame:
    x = l0(spark, d)
    return out(cleaning.l1_fallback(x.where(~cleaning.needs_model(x))), ["bb_id", *L1_TEXT], L1_SIZE)


@query
def clean_prompt(spark: SparkSession, d: str) -> DataFrame:
    x = l0(spark, d)
    return x.where(cleaning.needs_model(x)).select("bb_id", cleaning.clean_prompt(x, "A").alias("prompt"))


def asked(spark: SparkSession, d: str) -> DataFrame:
    x = l0(spark, d)
    return x.where(cleaning.needs_model(x)).join(fixtures.clean_replies(spark, d), "bb_id", "left")


@query
def llm_clean_stub(spark: SparkSession, d: str) -> DataFrame:
    """Each hard row's prompt through the worker port to a client that answers with the id that the prompt names."""

    def factory() -> Callable[[str], str]:
        return lambda prompt: "reply " + json.loads(prompt.split("\n")[1])["product_id"]

    return clients.ask(clean_prompt(spark, d), "prompt", "reply", factory).select("bb_id", "reply")


@query
def l1_decode(spark: SparkSession, d: str) -> DataFrame:
    return out(cleaning.l1_decode(asked(spark, d)), ["bb_id", *L1_TEXT], L1_SIZE)


@query
def l1_clean(spark: SparkSession, d: str) -> DataFrame:
    return out(l1(spark, d), ["bb_id", *L1_TEXT], L1_SIZE)


@query
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Records as JSON lines and back, in the plan."""
    x = l1_clean(spark, d)
    line = F.to_json(F.struct(*x.columns), {"ignoreNullFields": "false"})
    return x.select(F.from_json(line, x.schema).alias("r")).select("r.*")


@query
def fuse_brand(spark: SparkSession, d: str) -> DataFrame:
    return l1(spark, d).select("bb_id", cleaning.fuse_brand(c("brand"), c("brand_confidence"), c("brand_raw")).alias("f")).select("bb_id", "f.value", "f.source")


@query
def fuse_core(spark: SparkSession, d: str) -> DataFrame:
    return l1(spark, d).select("bb_id", cleaning.fuse_core(c("product_core"), c("product_core_confidence")).alias("f")).select("bb_id", "f.value", "f.source")


@query
def fuse_flavor(spark: SparkSession, d: str) -> DataFrame:
    return l1(spark, d).select("bb_id", cleaning.fuse_flavor(c("flavor"), c("flavor_confidence")).alias("f")).select("bb_id", "f.value", "f.source")


@query
def fuse_category(spark: SparkSession, d: str) -> DataFrame:
    f = cleaning.fuse_category(c("category_lvl1"), c("category_lvl1_confidence"), c("category_lvl2"), c("department"))
    return l1(spark, d).select("bb_id", f.alias("f")).select("bb_id", "f.lvl1", "f.lvl2", "f.source")


@query
def fuse_size(spark: SparkSession, d: str) -> DataFrame:
    f = cleaning.fuse_size({k: c(f"size_{k}") for k in KINDS}, c("size_confidence"), {k: c(f"size_{k}_l0") for k in KINDS})
    return l1(spark, d).select("bb_id", f.alias("f")).select("bb_id", *[r6(c(f"f.{k}")).alias(k) for k in KINDS], "f.source")


@query
def l2_clean(spark: SparkSession, d: str) -> DataFrame:
    return out(l2(spark, d), ["bb_id", "side", *FINAL_TEXT], FINAL_SIZE)


@query
def phase1_clean(spark: SparkSession, d: str) -> DataFrame:
    """The whole of phase one on both sides."""
    one = lambda side: pipeline.clean(raw(spark, d).where(c("side") == side).drop("side"), CatalogConfig(side), fixtures.clean_replies(spark, d))
    return out(one("A").unionByName(one("B")), ["bb_id", "side", "title_normalized_l0", *FINAL_TEXT], FINAL_SIZE)


@query
def size_display(spark: SparkSession, d: str) -> DataFrame:
    return l2(spark, d).select("bb_id", text.size_display(c("size_ml_final"), c("size_g_final"), c("size_count_final")).alias("size"))


@query
def embedding_text(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.with_embedding_text(l2(spark, d)).select("bb_id", "text_for_embedding")


@query
def embed_text(spark: SparkSession, d: str) -> DataFrame:
    return embedding_text(spark, d).select("bb_id", clients.embed(c("text_for_embedding")).alias("embedding"))


# ---- vectors


@query
def l2_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Every element of every unit vector, from vectors three times as long."""
    x = fixtures.vectors(spark, d).select("vec_id", F.transform("embedding", lambda v: v.cast("double") * 3).alias("v"))
    u = x.select("vec_id", "v", vec.l2_normalize(c("v")).alias("u"))
    each = u.select("vec_id", r6(vec.l2_norm(c("u"))).alias("norm"), r6(vec.l2_norm(c("v"))).alias("before"), F.posexplode("u").alias("position", "value"))
    return each.select("vec_id", c("position").cast("long").alias("position"), r6(c("value")).alias("value"), "norm", "before")


@query
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The cosine of every candidate pair, from the vectors of both sides."""
    a, b = vector_sides(spark, d)
    pairs = matching.topk(a, b, FIXTURE.k).select("a_id", "b_id")
    x = pairs.join(a.select(c("bb_id").alias("a_id"), c("embedding").alias("x")), "a_id").join(b.select(c("bb_id").alias("b_id"), c("embedding").alias("y")), "b_id")
    return x.select("a_id", "b_id", r6(vec.cosine(c("x"), c("y"))).alias("cosine"))


@query
def topk_candidates(spark: SparkSession, d: str) -> DataFrame:
    return matching.topk(*vector_sides(spark, d), FIXTURE.k).select("a_id", "b_id", r6(c("similarity")).alias("similarity"), c("rank").cast("long").alias("rank"))


@query
def topk_tiles(spark: SparkSession, d: str) -> DataFrame:
    """The search as it runs on a right side of any size: tiles of neighbours, met where their bounds allow."""
    found = nearest.topk(*vector_sides(spark, d), FIXTURE.k, carried=0, tile=64 << 10)
    return found.select("a_id", "b_id", r6(c("similarity")).alias("similarity"), c("rank").cast("long").alias("rank"))


@query
def topk_legacy_ranked(spark: SparkSession, d: str) -> DataFrame:
    x = matching.topk(*vector_sides(spark, d), FIXTURE.k)
    return x.select(c("a_id").alias("bb_id_A"), c("b_id").alias("bb_id_B"), c("rank").cast("long").alias("rank"), r6(c("similarity")).alias("sim_embedding"))


# ---- features and scores


def feature(name: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return candidates(spark, d).select("a_id", "b_id", r6(c(name)).alias(name))

    run.__name__ = name
    query(run)


for _n in ("feature_brand", "feature_category", "feature_embedding", "feature_size", "feature_size_strict"):
    feature(_n)


@query
def size_pair(spark: SparkSession, d: str) -> DataFrame:
    p = sizes.size_pair({k: c(f"a_size_{k}_final") for k in KINDS}, {k: c(f"b_size_{k}_final") for k in KINDS})
    return attributed(spark, d).select("a_id", "b_id", p.alias("p")).select("a_id", "b_id", r6(c("p.a")).alias("size_a"), r6(c("p.b")).alias("size_b"))


@query
def score_candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d).select("a_id", "b_id", c("rank").cast("long").alias("rank"), *[r6(c(n)).alias(n) for n in matching.FEATURES])


@query
def feature_summary(spark: SparkSession, d: str) -> DataFrame:
    x = matching.feature_summary(candidates(spark, d))
    return x.select("feature", c("count").alias("n"), *[F.round(c(n), 5).alias(n) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query
def best_per_a(spark: SparkSession, d: str) -> DataFrame:
    return matching.best_per_a(candidates(spark, d)).select("a_id", "b_id", c("rank").cast("long").alias("rank"), r6(c("score_total")).alias("score_total"))


@query
def matches_v0(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d).select("a_id", "b_id", "a_brand_final", "b_brand_final", *[r6(c(n)).alias(n) for n in matching.FEATURES])


@query
def match_coverage(spark: SparkSession, d: str) -> DataFrame:
    return matching.coverage(candidates(spark, d), FIXTURE)


@query
def filter_funnel(spark: SparkSession, d: str) -> DataFrame:
    return matching.funnel(candidates(spark, d), FIXTURE)


@query
def row_index(spark: SparkSession, d: str) -> DataFrame:
    """Row numbers of the catalog by id."""
    return numbering.row_index(raw(spark, d).select("bb_id", "side"), "bb_id")


# ---- product codes


@query
def upc_eligible(spark: SparkSession, d: str) -> DataFrame:
    return matching.upc_eligible(l0(spark, d)).select("bb_id", "side", "upc_clean_l0")


def cleaned_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = l2(spark, d)
    return x.where("side = 'A'"), x.where("side = 'B'")


def codes(spark: SparkSession, d: str) -> DataFrame:
    return matching.upc_join(*cleaned_sides(spark, d))


@query
def upc_join(spark: SparkSession, d: str) -> DataFrame:
    return codes(spark, d).select("a_bb_id", "b_bb_id", "upc_clean", r6(c("size_penalty")).alias("size_penalty"), c("title_overlap").cast("long").alias("title_overlap"))


@query
def main_size(spark: SparkSession, d: str) -> DataFrame:
    return l2(spark, d).select("bb_id", r6(sizes.main_size(*[c(f"size_{k}_final") for k in KINDS])).alias("size"))


@query
def title_overlap(spark: SparkSession, d: str) -> DataFrame:
    return codes(spark, d).select("a_bb_id", "b_bb_id", c("title_overlap").cast("long").alias("title_overlap"))


@query
def upc_exact(spark: SparkSession, d: str) -> DataFrame:
    return matching.upc_exact(*cleaned_sides(spark, d))


@query
def upc_merged(spark: SparkSession, d: str) -> DataFrame:
    """The best product of each code as it is found for hot codes: sizes merged in order, titles compared at the least difference."""
    x, y = (matching.coded(side, "upc_clean_l0", "bb_id") for side in cleaned_sides(spark, d))
    found = product_codes.nearest(x, y)
    return found.select("a_bb_id", "b_bb_id", "upc_clean", r6(c("size_penalty")).alias("size_penalty"), c("title_overlap").cast("long").alias("title_overlap"))


# ---- review and the final list


@query
def review_band(spark: SparkSession, d: str) -> DataFrame:
    return matching.review_band(kept(spark, d), FIXTURE).select("a_id", "b_id", r6(c("score_total")).alias("score_total"))


@query
def review_prompt(spark: SparkSession, d: str) -> DataFrame:
    x = matching.review_band(kept(spark, d), FIXTURE)
    return x.select("a_id", "b_id", matching.review_prompt(x).alias("prompt"))


@query
def review_decode(spark: SparkSession, d: str) -> DataFrame:
    x = raw(spark, d).withColumn("reply", F.expr(fixtures.REVIEW_REPLY_SQL.format(key="bb_id")))
    return matching.review_decode_native(x).select("bb_id", "gpt_label", r6(c("gpt_score")).alias("gpt_score"))


@query
def llm_review_stub(spark: SparkSession, d: str) -> DataFrame:
    """A label and a score for every pair of the band, however many there are."""
    return reviewed(matching.in_band(kept(spark, d), FIXTURE)).select("a_id", "b_id", "gpt_label", r6(c("gpt_score")).alias("gpt_score"))


def review_client() -> Callable[[str], str]:
    """Answers by the length of the first listing's title, in every form that a model's reply can take."""

    def answer(prompt: str) -> str:
        n = len(json.loads(prompt.split("\n")[0].split(": ", 1)[1])["title_normalized_l0"])
        if n % 10 < 2:
            return ("not json", "[1]")[n % 10]
        label, value = ("EXACT", "substitute", "none", "maybe")[n % 4], ("1.5", '"0.9"', "0.25")[n % 3]
        return f'{{"label":"{label}","score":{value}}}'

    return answer


def asked_reviews(band: DataFrame) -> DataFrame:
    """The band's pairs with what a client answered: asked for through a ledger of its own, and asked again without a client call."""
    path = f"{shared_folder(band.sparkSession)}/reviews-{uuid.uuid4().hex}"
    pipeline.ask_reviews(band, review_client, path, waves=2, per_second=1000.0, retries=1)
    return matching.review_decode(pipeline.ask_reviews(band, review_client, path))


@query
def review_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The review loop: prompts of the band, a client's replies kept in a ledger, decoded."""
    band = written(matching.review_band(kept(spark, d), FIXTURE))
    return asked_reviews(band).select("a_id", "b_id", "gpt_label", r6(c("gpt_score")).alias("gpt_score"))


@query
def phase2_resumed(spark: SparkSession, d: str) -> DataFrame:
    """The whole second phase in kept stages, run twice: the second run reads them all."""
    folder = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
    one, two = (runner.Runner(spark, folder) for _ in range(2))
    a, b = (written(x) for x in sides(spark, d))
    for run in (one, two):
        final_ = runner.match(run, run.source(a), run.source(b), FIXTURE, reviewed, halves)
    if any(how == "run" for _, how, _ in two.log):
        raise RuntimeError(f"stages ran again: {two.log}")
    return final_.df.select("bb_id_A", "bb_id_B", *[r6(c(n)).alias(n) for n in matching.FEATURES])


@query
def preview(spark: SparkSession, d: str) -> DataFrame:
    """The first rows of the embedding texts."""
    return matching.preview(embedding_text(spark, d), "bb_id")


@query
def review_blend(spark: SparkSession, d: str) -> DataFrame:
    x = matching.blended(reviewed(matching.review_band(kept(spark, d), FIXTURE)), FIXTURE)
    return x.select("a_id", "b_id", r6(c("final_score")).alias("final_score"))


def final(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.match(*sides(spark, d), FIXTURE, reviewed, halves)


@query
def final_matches(spark: SparkSession, d: str) -> DataFrame:
    return final(spark, d).select("a_id", "b_id", c("bb_id_A"), c("bb_id_B"), r6(c("score_total")).alias("score_total"))


@query
def final_pairs(spark: SparkSession, d: str) -> DataFrame:
    return matching.final_pairs(final(spark, d))


@query
def qa_sample(spark: SparkSession, d: str) -> DataFrame:
    return matching.sample(kept(spark, d), FIXTURE).select("a_id", "b_id", r6(c("score_total")).alias("score_total"))


@query
def phase2_match(spark: SparkSession, d: str) -> DataFrame:
    return final(spark, d).select("bb_id_A", "bb_id_B", *[r6(c(n)).alias(n) for n in matching.FEATURES])


# ---- the earlier path


def legacy_rows(spark: SparkSession, d: str) -> DataFrame:
    """Pair features that the earlier rule takes as given; these formulas are the fixture's own."""
    x = attributed(spark, d)
    p = sizes.size_pair({k: c(f"a_size_{k}_final") for k in KINDS}, {k: c(f"b_size_{k}_final") for k in KINDS})
    ta, tb = text.tokens(c("a_title_normalized_l0")), text.tokens(c("b_title_normalized_l0"))
    both = F.size(F.array_intersect(ta, tb)).cast("double")
    x = x.withColumn("p", p).select(
        c("a_id").alias("bb_id_A"), c("b_id").alias("bb_id_B"), c("similarity").alias("sim_embedding"), c("similarity").alias("sim_embedding_01"),
        (both / F.greatest(F.lit(1), F.size(F.array_union(ta, tb)))).alias("title_token_overlap"),
        features.same_text(c("a_brand_final"), c("b_brand_final")).alias("brand_match_score"),
        F.coalesce(F.lit(1.0) / sizes.ratio(c("p.a"), c("p.b")), F.lit(0.0)).alias("size_ratio"),
        features.same_text(c("a_category_lvl1_final"), c("b_category_lvl1_final")).alias("category_soft_match"),
    )
    return x.withColumn("weighted_score", F.lit(0.8) * c("sim_embedding_01") + F.lit(0.1) * c("title_token_overlap") + F.lit(0.1) * c("category_soft_match"))


LEGACY = ["weighted_score", "sim_embedding", "title_token_overlap", "brand_match_score", "size_ratio", "category_soft_match"]


@query
def legacy_rule_filter(spark: SparkSession, d: str) -> DataFrame:
    return out(matching.legacy_filter(legacy_rows(spark, d)), ["bb_id_A", "bb_id_B"], LEGACY)


@query
def legacy_select_best(spark: SparkSession, d: str) -> DataFrame:
    return out(matching.legacy_select(legacy_rows(spark, d)), ["bb_id_A", "bb_id_B"], LEGACY)
