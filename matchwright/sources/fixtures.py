"""A product catalog derived from the `part` and `embeddings` tables, and stored model replies, as SQL that two engines run alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG_SQL = """
SELECT p_partkey AS bb_id, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS side,
 concat('  ', upper(p_name), '  ', CAST(p_size AS STRING), CASE p_partkey % 9 WHEN 0 THEN ' oz' WHEN 1 THEN 'ML' WHEN 2 THEN ' g' WHEN 3 THEN ' kg' WHEN 4 THEN ' ct' WHEN 5 THEN ' lb' WHEN 6 THEN ' L' WHEN 7 THEN ' fl oz' ELSE '' END) AS name,
 CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat('0-', CAST(p_partkey - p_partkey % 4 AS STRING), ' x') END AS upc_raw,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand_raw,
 CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CASE p_type WHEN 'ECONOMY' THEN 'Frozen Meat' WHEN 'MEDIUM' THEN 'Dairy & Eggs' WHEN 'STANDARD' THEN 'Beverages' WHEN 'PROMO' THEN 'Snack Aisle' WHEN 'SMALL' THEN 'Pet Care' ELSE 'Center Store' END END AS department,
 CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_partkey % 5 = 0 END AS is_private_label
FROM part
"""

#: Replies to the cleaning prompt: no JSON, an array, and objects with known, blank and unknown values of each field.
CLEAN_REPLY_SQL = """
SELECT bb_id, CASE WHEN bb_id % 10 = 0 THEN 'not json' WHEN bb_id % 10 = 1 THEN '[1]' ELSE concat(
 '{"brand":"', CASE bb_id % 4 WHEN 0 THEN ' Acme ' WHEN 1 THEN 'unknown' WHEN 2 THEN '' ELSE 'Best' END,
 '","brand_confidence":"', CASE bb_id % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'medium' ELSE 'low' END,
 '","is_private_label":', CASE bb_id % 5 WHEN 2 THEN 'true' WHEN 3 THEN 'null' ELSE 'false' END,
 ',"product_core":"', CASE bb_id % 3 WHEN 0 THEN 'UNKNOWN' ELSE ' green tea' END, '","product_core_confidence":"', CASE bb_id % 2 WHEN 0 THEN 'high' ELSE 'low' END,
 '","flavor":"', CASE bb_id % 4 WHEN 0 THEN 'none' ELSE 'Lemon' END, '","flavor_confidence":"medium","category_lvl1":"', CASE bb_id % 3 WHEN 0 THEN 'other_unknown' ELSE 'snacks' END,
 '","category_lvl1_confidence":"high","category_lvl2":"', CASE bb_id % 2 WHEN 0 THEN '' ELSE 'chips' END, '","category_lvl2_confidence":"low","notes":"n","size_ml":', CASE bb_id % 4 WHEN 0 THEN '250' WHEN 1 THEN '"x"' ELSE 'null' END,
 ',"size_g":', CASE bb_id % 6 WHEN 0 THEN '12.5' ELSE 'null' END, ',"size_count":null,"size_confidence":"', CASE bb_id % 3 WHEN 0 THEN 'high' ELSE 'medium' END, '"}') END AS reply
FROM fx
"""

#: Replies to the review prompt, by `key`: no JSON, an array, labels in and out of the vocabulary, scores above 1 and as text.
REVIEW_REPLY_SQL = """
CASE WHEN {key} % 10 = 0 THEN 'not json' WHEN {key} % 10 = 1 THEN '[1]' ELSE concat('{{"label":"', CASE {key} % 4 WHEN 0 THEN 'EXACT' WHEN 1 THEN 'substitute' WHEN 2 THEN 'none' ELSE 'maybe' END, '","score":', CASE {key} % 3 WHEN 0 THEN '1.5' WHEN 1 THEN '"0.9"' ELSE '0.25' END, '}}') END
"""
#: Left ids are even; half of them reaches every kind of reply.
PAIR_KEY = "CAST(a_id / 2 AS BIGINT)"


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CATALOG_SQL.replace("FROM part", "FROM {part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def clean_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CLEAN_REPLY_SQL.replace("{", "{{").replace("}", "}}").replace("FROM fx", "FROM {fx}"), fx=catalog(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
