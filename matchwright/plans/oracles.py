"""The SQL that each registered query must equal, written on its own over the same tables."""

from __future__ import annotations

from matchwright.operators.cleaning import CLEAN_ASK
from matchwright.operators.matching import REVIEW_ASK
from matchwright.sources.fixtures import CATALOG_SQL, CLEAN_REPLY_SQL, PAIR_KEY, REVIEW_REPLY_SQL


def blank(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) = '')"


def department(x: str) -> str:
    """Words and categories in the order of the rules."""
    low = f"lower({x})"
    rules = [
        (("produce", "fruit", "vegetable"), "fresh_produce"), (("meat",), "meat"), (("seafood", "fish"), "seafood"), (("dairy", "milk", "cheese"), "dairy"),
        (("egg",), "eggs"), (("bakery", "bread"), "bakery"), (("frozen",), "frozen_food"), (("alcohol", "wine", "beer", "liquor"), "alcohol"),
        (("beverage", "drink", "soda", "juice"), "beverage_non_alcohol"), (("snack", "chips", "candy", "cookies"), "snacks"), (("cereal", "breakfast"), "breakfast_cereal"),
        (("baby",), "baby"), (("pet",), "pet"), (("household", "clean", "paper"), "household"), (("personal", "beauty", "hair", "skin"), "personal_care"),
    ]
    cases = " ".join(f"WHEN {' OR '.join(f'contains({low}, {w!r})' for w in words)} THEN '{cat}'" for words, cat in rules)
    return f"CASE WHEN {x} IS NULL THEN 'other_unknown' {cases} ELSE 'pantry' END"


TITLE = r"regexp_replace(lower(trim(name)), '\s+', ' ', 'g')"
UPC = r"nullif(regexp_replace(upc_raw, '\D', '', 'g'), '')"
SIZE = r"'(\d+(?:\.\d+)?)\s*([a-zA-Z]+)'"

L0 = f"""
fx AS ({CATALOG_SQL}),
l0a AS (SELECT *, name AS title_raw, {TITLE} AS title_normalized_l0, {UPC} AS upc_clean_l0, {UPC} IS NOT NULL AS has_upc_l0, department AS category_raw, bb_id AS product_id FROM fx),
l0b AS (SELECT *, try_cast(nullif(regexp_extract(title_normalized_l0, {SIZE}, 1), '') AS DOUBLE) AS size_value_raw_l0,
  nullif(regexp_extract(title_normalized_l0, {SIZE}, 2), '') AS size_unit_raw_l0 FROM l0a),
l0 AS (SELECT *,
  CASE WHEN size_unit_raw_l0 = 'ml' THEN size_value_raw_l0 WHEN size_unit_raw_l0 IN ('l', 'lt', 'liter') THEN size_value_raw_l0 * 1000::DOUBLE END AS size_ml_l0,
  CASE WHEN size_unit_raw_l0 = 'g' THEN size_value_raw_l0 WHEN size_unit_raw_l0 IN ('kg', 'kgs') THEN size_value_raw_l0 * 1000::DOUBLE
    WHEN size_unit_raw_l0 IN ('oz', 'ounce', 'ounces') THEN size_value_raw_l0 * 28.3495::DOUBLE WHEN size_unit_raw_l0 IN ('lb', 'lbs') THEN size_value_raw_l0 * 453.592::DOUBLE END AS size_g_l0,
  CASE WHEN size_unit_raw_l0 IN ('ct', 'cnt', 'count', 'pk', 'pack') THEN size_value_raw_l0 END AS size_count_l0,
  CASE WHEN size_unit_raw_l0 IN ('ml', 'l', 'lt', 'liter') THEN 'ml' WHEN size_unit_raw_l0 IN ('g', 'kg', 'kgs', 'oz', 'ounce', 'ounces', 'lb', 'lbs') THEN 'g'
    WHEN size_unit_raw_l0 IN ('ct', 'cnt', 'count', 'pk', 'pack') THEN 'count' END AS size_unit_norm_l0,
  {blank('brand_raw')} OR {blank('department')} AS hard FROM l0b)"""


def text_field(name: str) -> str:
    return f"CASE WHEN ok THEN json_extract_string(j, '$.{name}') ELSE"


L1 = f"""{L0},
creply AS ({CLEAN_REPLY_SQL}),
asked AS (SELECT l0.*, reply, coalesce(json_valid(reply) AND json_type(CASE WHEN json_valid(reply) THEN reply ELSE 'null' END) = 'OBJECT', false) AS ok,
  CASE WHEN json_valid(reply) THEN reply ELSE '{{}}' END AS j FROM l0 LEFT JOIN creply ON l0.bb_id = creply.bb_id WHERE hard),
decoded AS (SELECT * EXCLUDE (reply, ok, j), {text_field('brand')} 'UNKNOWN' END AS brand, {text_field('brand_confidence')} 'low' END AS brand_confidence,
  CASE WHEN ok THEN try_cast(json_extract_string(j, '$.is_private_label') AS BOOLEAN) END AS is_private_label_llm,
  {text_field('product_core')} 'UNKNOWN' END AS product_core, {text_field('product_core_confidence')} 'low' END AS product_core_confidence,
  {text_field('flavor')} 'NONE' END AS flavor, {text_field('flavor_confidence')} 'low' END AS flavor_confidence,
  {text_field('category_lvl1')} 'other_unknown' END AS category_lvl1, {text_field('category_lvl1_confidence')} 'low' END AS category_lvl1_confidence,
  {text_field('category_lvl2')} 'NONE' END AS category_lvl2, {text_field('category_lvl2_confidence')} 'low' END AS category_lvl2_confidence,
  {text_field('notes')} CASE WHEN reply IS NULL THEN 'GPT_API_ERROR' ELSE 'GPT_JSON_PARSE_ERROR' END END AS notes,
  CASE WHEN ok THEN try_cast(json_extract_string(j, '$.size_ml') AS DOUBLE) ELSE size_ml_l0 END AS size_ml,
  CASE WHEN ok THEN try_cast(json_extract_string(j, '$.size_g') AS DOUBLE) ELSE size_g_l0 END AS size_g,
  CASE WHEN ok THEN try_cast(json_extract_string(j, '$.size_count') AS DOUBLE) ELSE size_count_l0 END AS size_count,
  {text_field('size_confidence')} NULL END AS size_confidence FROM asked),
easy AS (SELECT *, trim(brand_raw) AS brand, CASE WHEN trim(brand_raw) <> 'UNKNOWN' THEN 'medium' ELSE 'low' END AS brand_confidence, is_private_label AS is_private_label_llm,
  'UNKNOWN' AS product_core, 'low' AS product_core_confidence, 'NONE' AS flavor, 'low' AS flavor_confidence, {department('department')} AS category_lvl1,
  'medium' AS category_lvl1_confidence, 'NONE' AS category_lvl2, 'low' AS category_lvl2_confidence, 'SKIPPED_GPT_EASY_ROW' AS notes,
  size_ml_l0 AS size_ml, size_g_l0 AS size_g, size_count_l0 AS size_count, NULL::VARCHAR AS size_confidence FROM l0 WHERE NOT hard),
l1 AS (SELECT * FROM easy UNION ALL BY NAME SELECT * FROM decoded)"""


def reliable(x: str) -> str:
    return f"lower(coalesce({x}, 'low')) IN ('high', 'medium')"


BRAND_OK = f"({reliable('brand_confidence')} AND NOT {blank('brand')} AND upper(trim(brand)) <> 'UNKNOWN')"
CORE_OK = f"({reliable('product_core_confidence')} AND NOT {blank('product_core')} AND upper(trim(product_core)) <> 'UNKNOWN')"
FLAVOR_OK = f"({reliable('flavor_confidence')} AND NOT {blank('flavor')} AND upper(trim(flavor)) <> 'NONE')"
CATEGORY_OK = f"({reliable('category_lvl1_confidence')} AND NOT {blank('category_lvl1')} AND trim(category_lvl1) <> 'other_unknown')"
SURE = "lower(coalesce(size_confidence, '')) = 'high'"

L2 = f"""{L1},
l2 AS (SELECT *,
  CASE WHEN {BRAND_OK} THEN trim(brand) WHEN NOT {blank('brand_raw')} THEN trim(brand_raw) ELSE 'UNKNOWN' END AS brand_final,
  CASE WHEN {BRAND_OK} THEN 'gpt' WHEN NOT {blank('brand_raw')} THEN 'raw' ELSE 'none' END AS brand_final_source,
  CASE WHEN {CORE_OK} THEN trim(product_core) ELSE 'UNKNOWN' END AS product_core_final, CASE WHEN {CORE_OK} THEN 'gpt' ELSE 'none' END AS product_core_final_source,
  CASE WHEN {FLAVOR_OK} THEN trim(flavor) ELSE 'NONE' END AS flavor_final, CASE WHEN {FLAVOR_OK} THEN 'gpt' ELSE 'none' END AS flavor_final_source,
  CASE WHEN {CATEGORY_OK} THEN trim(category_lvl1) ELSE {department('department')} END AS category_lvl1_final,
  CASE WHEN {CATEGORY_OK} AND NOT {blank('category_lvl2')} THEN trim(category_lvl2) ELSE 'NONE' END AS category_lvl2_final,
  CASE WHEN {CATEGORY_OK} THEN 'gpt' ELSE 'department_fallback' END AS category_final_source,
  coalesce(CASE WHEN {SURE} THEN size_ml END, size_ml_l0) AS size_ml_final, coalesce(CASE WHEN {SURE} THEN size_g END, size_g_l0) AS size_g_final,
  coalesce(CASE WHEN {SURE} THEN size_count END, size_count_l0) AS size_count_final,
  CASE WHEN {SURE} AND coalesce(size_ml, size_g, size_count) IS NOT NULL THEN 'gpt' WHEN coalesce(size_ml_l0, size_g_l0, size_count_l0) IS NOT NULL THEN 'l0' ELSE 'none' END AS size_final_source
  FROM l1)"""

VECTORS = f"""fx AS ({CATALOG_SQL}),
fv AS (SELECT bb_id, side, embedding::DOUBLE[] AS v FROM fx JOIN embeddings ON vec_id = bb_id)"""

NEAR = """
near AS (SELECT * FROM (SELECT a.bb_id AS a_id, b.bb_id AS b_id, list_cosine_similarity(a.v, b.v) AS cosine,
  row_number() OVER (PARTITION BY a.bb_id ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.bb_id) AS rank FROM fv a, fv b WHERE a.side = 'A' AND b.side = 'B') WHERE rank <= 50)"""


def norm(x: str) -> str:
    return f"lower(trim(coalesce({x}, '')))"


def same(a: str, b: str) -> str:
    return f"CASE WHEN {norm(a)} <> '' AND {norm(a)} = {norm(b)} THEN 1::DOUBLE ELSE 0::DOUBLE END"


SCORED = f"""{L2},
fv AS (SELECT bb_id, side, embedding::DOUBLE[] AS v FROM fx JOIN embeddings ON vec_id = bb_id),{NEAR},
pair AS (SELECT near.a_id, near.b_id, near.rank, (1 + cosine) / 2 AS similarity, a.brand_final AS a_brand_final, b.brand_final AS b_brand_final,
  a.category_lvl1_final AS a_category, b.category_lvl1_final AS b_category, a.title_normalized_l0 AS a_title, b.title_normalized_l0 AS b_title,
  CASE WHEN a.size_ml_final IS NOT NULL AND b.size_ml_final IS NOT NULL THEN a.size_ml_final WHEN a.size_g_final IS NOT NULL AND b.size_g_final IS NOT NULL THEN a.size_g_final
    WHEN a.size_count_final IS NOT NULL AND b.size_count_final IS NOT NULL THEN a.size_count_final END AS size_a,
  CASE WHEN a.size_ml_final IS NOT NULL AND b.size_ml_final IS NOT NULL THEN b.size_ml_final WHEN a.size_g_final IS NOT NULL AND b.size_g_final IS NOT NULL THEN b.size_g_final
    WHEN a.size_count_final IS NOT NULL AND b.size_count_final IS NOT NULL THEN b.size_count_final END AS size_b
  FROM near JOIN l2 a ON a.bb_id = near.a_id JOIN l2 b ON b.bb_id = near.b_id),
ratio AS (SELECT *, CASE WHEN size_a > 0 AND size_b > 0 THEN greatest(size_a, size_b) / least(size_a, size_b) END AS r FROM pair),
feat AS (SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, similarity)) AS feature_embedding, {same('a_brand_final', 'b_brand_final')} AS feature_brand, {same('a_category', 'b_category')} AS feature_category,
  CASE WHEN r <= 1.25::DOUBLE THEN 1::DOUBLE WHEN r <= 1.5::DOUBLE THEN 0.7::DOUBLE WHEN r <= 2 THEN 0.4::DOUBLE ELSE 0::DOUBLE END AS feature_size,
  CASE WHEN r <= 1.05::DOUBLE THEN 1::DOUBLE ELSE 0::DOUBLE END AS feature_size_strict FROM ratio),
scored AS (SELECT *, 0.55::DOUBLE * feature_embedding + 0.15::DOUBLE * feature_brand + 0.15::DOUBLE * feature_category + 0.05::DOUBLE * feature_size + 0.1::DOUBLE * feature_size_strict AS score_total FROM feat),
best AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY score_total DESC, rank, b_id) AS k FROM scored) WHERE k = 1),
v0 AS (SELECT * FROM best WHERE (score_total >= 0.5::DOUBLE AND feature_embedding >= 0.55::DOUBLE AND feature_category >= 0.5::DOUBLE)
  OR (feature_category >= 0.5::DOUBLE AND feature_size_strict >= 0.5::DOUBLE AND score_total >= 0.45::DOUBLE AND feature_embedding >= 0.5::DOUBLE))"""


def decoded(source: str, key: str, name: str) -> str:
    return f"""
{name}r AS (SELECT *, {REVIEW_REPLY_SQL.format(key=key)} AS reply FROM {source}),
{name}j AS (SELECT *, coalesce(json_valid(reply) AND json_type(CASE WHEN json_valid(reply) THEN reply ELSE 'null' END) = 'OBJECT', false) AS ok, CASE WHEN json_valid(reply) THEN reply ELSE '{{}}' END AS j FROM {name}r),
{name} AS (SELECT * EXCLUDE (reply, ok, j), CASE WHEN ok AND lower(json_extract_string(j, '$.label')) IN ('exact', 'substitute', 'none') THEN lower(json_extract_string(j, '$.label')) ELSE 'none' END AS gpt_label,
  CASE WHEN ok THEN greatest(0::DOUBLE, least(1::DOUBLE, try_cast(json_extract_string(j, '$.score') AS DOUBLE))) ELSE 0::DOUBLE END AS gpt_score FROM {name}j)"""


REVIEW = f"""{SCORED},
band AS (SELECT * FROM v0 WHERE score_total >= 0.45::DOUBLE AND score_total < 0.52::DOUBLE ORDER BY a_id LIMIT 2000),{decoded('band', PAIR_KEY, 'rev')}"""
FINAL = f"""{REVIEW},
fin AS (SELECT * FROM v0 WHERE NOT EXISTS (SELECT 1 FROM rev WHERE rev.a_id = v0.a_id AND rev.b_id = v0.b_id AND gpt_label = 'none'))"""

CODES = f"""{L2},
elig AS (SELECT *, coalesce(size_ml_final, size_g_final, size_count_final) AS main FROM l2 WHERE upc_clean_l0 IS NOT NULL AND upc_clean_l0 <> '' AND is_private_label = false),
code AS (SELECT a.bb_id AS a_bb_id, b.bb_id AS b_bb_id, a.upc_clean_l0 AS upc_clean, coalesce(abs(a.main - b.main), 9999::DOUBLE) AS size_penalty,
  len(list_intersect(list_distinct(list_filter(string_split(a.title_normalized_l0, ' '), lambda x: x <> '')), list_distinct(list_filter(string_split(b.title_normalized_l0, ' '), lambda x: x <> ''))))::BIGINT AS title_overlap
  FROM elig a JOIN elig b ON a.upc_clean_l0 = b.upc_clean_l0 WHERE a.side = 'A' AND b.side = 'B')"""

LEGACY = f"""{SCORED},
tok AS (SELECT *, list_distinct(list_filter(string_split(a_title, ' '), lambda x: x <> '')) AS ta, list_distinct(list_filter(string_split(b_title, ' '), lambda x: x <> '')) AS tb FROM scored),
leg0 AS (SELECT a_id AS bb_id_A, b_id AS bb_id_B, similarity AS sim_embedding, len(list_intersect(ta, tb))::DOUBLE / greatest(1, len(list_distinct(list_concat(ta, tb)))) AS title_token_overlap,
  feature_brand AS brand_match_score, coalesce(1::DOUBLE / r, 0::DOUBLE) AS size_ratio, feature_category AS category_soft_match FROM tok),
leg1 AS (SELECT *, 0.8::DOUBLE * sim_embedding + 0.1::DOUBLE * title_token_overlap + 0.1::DOUBLE * category_soft_match AS weighted_score FROM leg0),
leg AS (SELECT * FROM leg1 WHERE sim_embedding >= 0.45::DOUBLE AND weighted_score >= 0.55::DOUBLE AND (category_soft_match >= 0.05::DOUBLE OR title_token_overlap >= 0.1::DOUBLE))"""


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def w(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


L1_TEXT = "brand, brand_confidence, is_private_label_llm, product_core, product_core_confidence, flavor, flavor_confidence, category_lvl1, category_lvl1_confidence, category_lvl2, category_lvl2_confidence, notes, size_confidence"
L1_OUT = f"bb_id, {L1_TEXT}, {r6('size_ml', 'size_g', 'size_count')}"
FINAL_OUT = f"brand_final, brand_final_source, product_core_final, product_core_final_source, flavor_final, flavor_final_source, category_lvl1_final, category_lvl2_final, category_final_source, size_final_source, {r6('size_ml_final', 'size_g_final', 'size_count_final')}"
ALL = r6("feature_embedding", "feature_brand", "feature_category", "feature_size", "feature_size_strict", "score_total")
LEGACY_OUT = "bb_id_A, bb_id_B, " + r6("weighted_score", "sim_embedding", "title_token_overlap", "brand_match_score", "size_ratio", "category_soft_match")


def shown(x: str, unit: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN concat(CASE WHEN abs({x} - round({x})) < 1e-6 THEN CAST(CAST(round({x}) AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END, ' {unit}') END"


def label(name: str, x: str) -> str:
    return f"CASE WHEN NOT ({blank(x)} OR upper(trim({x})) IN ('UNKNOWN', 'NONE')) THEN concat('{name}: ', trim({x})) END"


FX = f"fx AS ({CATALOG_SQL})"
SHOWN = f"concat_ws(', ', {shown('size_count_final', 'count')}, {shown('size_ml_final', 'ml')}, {shown('size_g_final', 'g')})"



def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def json_of(**fields: str) -> str:
    return "CAST(to_json({" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}) AS VARCHAR)"


LISTED = ("title_normalized_l0", "title_raw", "brand_raw", "department", "category_raw", "is_private_label", "size_value_raw_l0", "size_unit_raw_l0", "size_ml_l0", "size_g_l0", "size_count_l0", "size_unit_norm_l0")
SHOWN_SIDE = ("title_normalized_l0", "brand_final", "category_lvl1_final", "size_ml_final", "size_g_final", "size_count_final")
PROMPTS = f"""{REVIEW},
shown AS (SELECT band.a_id, band.b_id, {json_of(**{n: f'a.{n}' for n in SHOWN_SIDE})} AS x, {json_of(**{n: f'b.{n}' for n in SHOWN_SIDE})} AS y
  FROM band JOIN l2 a ON a.bb_id = band.a_id JOIN l2 b ON b.bb_id = band.b_id)"""

ORACLE_SQL = {
    "scan_catalog": w(FX, "SELECT * FROM fx"),
    "normalize_title": w(FX, f"SELECT bb_id, {TITLE} AS title FROM fx"),
    "clean_upc": w(FX, f"SELECT bb_id, {UPC} AS upc, {UPC} IS NOT NULL AS has_upc FROM fx"),
    "parse_size": w(L0, "SELECT bb_id, size_value_raw_l0 AS value, size_unit_raw_l0 AS unit FROM l0"),
    "normalize_size": w(L0, "SELECT bb_id, round(size_ml_l0, 6) AS ml, round(size_g_l0, 6) AS g, round(size_count_l0, 6) AS count, size_unit_norm_l0 AS kind FROM l0"),
    "map_department": w(FX, f"SELECT bb_id, {department('department')} AS category FROM fx"),
    "is_blank": w(FX, f"SELECT bb_id, {blank('brand_raw')} AS brand_blank, {blank('department')} AS department_blank FROM fx"),
    "l0_clean": w(L0, f"SELECT * EXCLUDE (hard, size_ml_l0, size_g_l0, size_count_l0), {r6('size_ml_l0', 'size_g_l0', 'size_count_l0')} FROM l0"),
    "l1_route": w(L0, "SELECT bb_id, hard FROM l0"),
    "l1_route_counts": w(L0, "SELECT hard, count(*) AS n FROM l0 GROUP BY hard"),
    "l1_limit": w(L0, "SELECT bb_id, title_normalized_l0 FROM l0 ORDER BY bb_id LIMIT 100"),
    "l1_fallback": w(L1, f"SELECT {L1_OUT} FROM easy"),
    "llm_clean_stub": w(L0, "SELECT bb_id, concat('reply ', CAST(bb_id AS VARCHAR)) AS reply FROM l0 WHERE hard"),
    "l1_decode": w(L1, f"SELECT {L1_OUT} FROM decoded"),
    "l1_clean": w(L1, f"SELECT {L1_OUT} FROM l1"),
    "jsonl_roundtrip": w(L1, f"SELECT {L1_OUT} FROM l1"),
    "fuse_brand": w(L2, "SELECT bb_id, brand_final AS value, brand_final_source AS source FROM l2"),
    "fuse_core": w(L2, "SELECT bb_id, product_core_final AS value, product_core_final_source AS source FROM l2"),
    "fuse_flavor": w(L2, "SELECT bb_id, flavor_final AS value, flavor_final_source AS source FROM l2"),
    "fuse_category": w(L2, "SELECT bb_id, category_lvl1_final AS lvl1, category_lvl2_final AS lvl2, category_final_source AS source FROM l2"),
    "fuse_size": w(L2, "SELECT bb_id, round(size_ml_final, 6) AS ml, round(size_g_final, 6) AS g, round(size_count_final, 6) AS count, size_final_source AS source FROM l2"),
    "l2_clean": w(L2, f"SELECT bb_id, side, {FINAL_OUT} FROM l2"),
    "phase1_clean": w(L2, f"SELECT bb_id, side, title_normalized_l0, {FINAL_OUT} FROM l2"),
    "size_display": w(L2, f"SELECT bb_id, concat_ws(', ', {shown('size_count_final', 'count')}, {shown('size_ml_final', 'ml')}, {shown('size_g_final', 'g')}) AS size FROM l2"),
    "embedding_text": w(L2, f"""SELECT bb_id, concat_ws(', ', title_normalized_l0, {label('brand', 'brand_final')}, {label('core', 'product_core_final')}, {label('flavor', 'flavor_final')},
  CASE WHEN {SHOWN} <> '' THEN concat('size: ', {SHOWN}) END, {label('category', 'category_lvl1_final')}) AS text_for_embedding FROM l2"""),
    "preview": w(L2, f"""SELECT bb_id, concat_ws(', ', title_normalized_l0, {label('brand', 'brand_final')}, {label('core', 'product_core_final')}, {label('flavor', 'flavor_final')},
  CASE WHEN {SHOWN} <> '' THEN concat('size: ', {SHOWN}) END, {label('category', 'category_lvl1_final')}) AS text_for_embedding FROM l2 ORDER BY bb_id LIMIT 5"""),
    "l2_normalize": """WITH e AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * 3) AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS b FROM e)
SELECT vec_id, i - 1 AS position, round(v[i] / b, 6) AS value, round(sqrt(list_sum(list_transform(v, lambda x: (x / b) * (x / b)))), 6) AS norm, round(b, 6) AS before FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM n)""",
    "cosine_pairs": w(VECTORS + "," + NEAR, "SELECT a_id, b_id, round(cosine, 6) AS cosine FROM near"),
    "topk_candidates": w(VECTORS + "," + NEAR, "SELECT a_id, b_id, round(cosine, 6) AS similarity, rank FROM near"),
    "topk_tiles": w(VECTORS + "," + NEAR, "SELECT a_id, b_id, round(cosine, 6) AS similarity, rank FROM near"),
    "topk_legacy_ranked": w(VECTORS + "," + NEAR, "SELECT a_id AS bb_id_A, b_id AS bb_id_B, rank, round(cosine, 6) AS sim_embedding FROM near"),
    **{f: w(SCORED, f"SELECT a_id, b_id, {r6(f)} FROM scored") for f in ("feature_brand", "feature_category", "feature_embedding", "feature_size", "feature_size_strict")},
    "size_pair": w(SCORED, f"SELECT a_id, b_id, {r6('size_a', 'size_b')} FROM pair"),
    "score_candidates": w(SCORED, f"SELECT a_id, b_id, rank, {ALL} FROM scored"),
    "feature_summary": w(SCORED, " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count({f}) AS n, round(avg({f}), 5) AS mean, round(stddev_samp({f}), 5) AS std, round(min({f}), 5) AS min, round(quantile_cont({f}, 0.25), 5) AS p25, round(quantile_cont({f}, 0.5), 5) AS p50, round(quantile_cont({f}, 0.75), 5) AS p75, round(max({f}), 5) AS max FROM scored"
        for f in ("feature_embedding", "feature_brand", "feature_category", "feature_size", "feature_size_strict", "score_total"))),
    "best_per_a": w(SCORED, f"SELECT a_id, b_id, rank, {r6('score_total')} FROM best"),
    "matches_v0": w(SCORED, f"SELECT a_id, b_id, a_brand_final, b_brand_final, {ALL} FROM v0"),
    "match_coverage": w(SCORED, "SELECT (SELECT count(DISTINCT a_id) FROM scored) AS n_a, (SELECT count(DISTINCT a_id) FROM v0) AS n_matched"),
    "filter_funnel": w(SCORED, "SELECT 'candidates' AS step, count(*) AS n, count(*) FILTER (b_id IS NULL) AS n_missing FROM scored UNION ALL SELECT 'best', count(*), count(*) FILTER (b_id IS NULL) FROM best UNION ALL SELECT 'matches', count(*), count(*) FILTER (b_id IS NULL) FROM v0"),
    "row_index": w(FX, "SELECT bb_id, side, row_number() OVER (ORDER BY bb_id) - 1 AS row_index FROM fx"),
    "upc_eligible": w(L0, "SELECT bb_id, side, upc_clean_l0 FROM l0 WHERE upc_clean_l0 IS NOT NULL AND upc_clean_l0 <> '' AND is_private_label = false"),
    "upc_join": w(CODES, f"SELECT a_bb_id, b_bb_id, upc_clean, {r6('size_penalty')}, title_overlap FROM code"),
    "main_size": w(L2, "SELECT bb_id, round(coalesce(size_ml_final, size_g_final, size_count_final), 6) AS size FROM l2"),
    "title_overlap": w(CODES, "SELECT a_bb_id, b_bb_id, title_overlap FROM code"),
    "upc_exact": w(CODES, "SELECT a_bb_id, b_bb_id, upc_clean, 'upc_exact' AS match_type FROM (SELECT *, row_number() OVER (PARTITION BY a_bb_id ORDER BY size_penalty, title_overlap DESC, b_bb_id) AS k FROM code) WHERE k = 1"),
    "upc_merged": w(CODES, f"SELECT a_bb_id, b_bb_id, upc_clean, {r6('size_penalty')}, title_overlap FROM (SELECT *, row_number() OVER (PARTITION BY a_bb_id ORDER BY size_penalty, title_overlap DESC, b_bb_id) AS k FROM code) WHERE k = 1"),
    "review_band": w(REVIEW, f"SELECT a_id, b_id, {r6('score_total')} FROM band"),
    "review_decode": w(f"{FX},{decoded('fx', 'bb_id', 'rd')}", f"SELECT bb_id, gpt_label, {r6('gpt_score')} FROM rd"),
    "llm_review_stub": w(REVIEW, f"SELECT a_id, b_id, gpt_label, {r6('gpt_score')} FROM rev"),
    "clean_prompt": w(L0, f"SELECT bb_id, concat({quoted(CLEAN_ASK[0])}, {json_of(product_id='CAST(bb_id AS VARCHAR)', side=quoted('A'), **{n: n for n in LISTED})}, {quoted(CLEAN_ASK[1])}) AS prompt FROM l0 WHERE hard"),
    "review_prompt": w(PROMPTS, f"SELECT a_id, b_id, concat({quoted(REVIEW_ASK[0])}, x, {quoted(REVIEW_ASK[1])}, y, {quoted(REVIEW_ASK[2])}) AS prompt FROM shown"),
    "review_ledger": w(f"{REVIEW},{decoded('band', 'length(a_title)', 'led')}", f"SELECT a_id, b_id, gpt_label, {r6('gpt_score')} FROM led"),
    "qa_sample": w(SCORED, f"SELECT a_id, b_id, {r6('score_total')} FROM v0 ORDER BY md5(concat('42:', CAST(a_id AS VARCHAR))), a_id LIMIT 50"),
    "phase2_resumed": w(FINAL, f"SELECT a_id AS bb_id_A, b_id AS bb_id_B, {ALL} FROM fin"),
    "review_blend": w(REVIEW, "SELECT a_id, b_id, round(0.6::DOUBLE * score_total + 0.4::DOUBLE * gpt_score, 6) AS final_score FROM rev"),
    "final_matches": w(FINAL, f"SELECT a_id, b_id, a_id AS bb_id_A, b_id AS bb_id_B, {r6('score_total')} FROM fin"),
    "final_pairs": w(FINAL, "SELECT DISTINCT a_id AS bb_id_A, b_id AS bb_id_B FROM fin"),
    "phase2_match": w(FINAL, f"SELECT a_id AS bb_id_A, b_id AS bb_id_B, {ALL} FROM fin"),
    "legacy_rule_filter": w(LEGACY, f"SELECT {LEGACY_OUT} FROM leg"),
    "legacy_select_best": w(LEGACY, f"SELECT {LEGACY_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY bb_id_A ORDER BY weighted_score DESC, bb_id_B) AS k FROM leg) WHERE k = 1"),
}
