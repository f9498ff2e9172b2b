"""Phase one: rule cleaning, routing to a model, decoding its replies, and fusing both by field."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.functions import sizes, taxonomy, text
from matchwright.plans.policy import CatalogConfig
from matchwright.sources.ledger import latest

RELIABLE = ("high", "medium")
# Names of a reply's fields, and the notes and sources that mark where a value comes from.
REPLY_TEXT = ("brand", "brand_confidence", "product_core", "product_core_confidence", "flavor", "flavor_confidence", "category_lvl1", "category_lvl1_confidence", "category_lvl2", "category_lvl2_confidence", "notes")
REPLY_SIZE = ("size_ml", "size_g", "size_count")
#: What stands before and after the listing in the cleaning prompt.
CLEAN_ASK = (
    "Product listing as JSON:\n",
    f"\nAnswer with a single JSON object holding exactly the keys {', '.join(['product_id', 'side', *REPLY_TEXT, 'is_private_label', *REPLY_SIZE, 'size_confidence'])}. "
    "Confidence is high, medium or low. An unknown brand or product core is UNKNOWN, an absent flavor or second category NONE, a doubtful first category "
    "other_unknown. Keep the given sizes unless the text shows better ones.",
)
EASY, NO_REPLY, BAD_REPLY = "SKIPPED_GPT_EASY_ROW", "GPT_API_ERROR", "GPT_JSON_PARSE_ERROR"
MODEL, RAW, RULES, DEPARTMENT, NOTHING = "gpt", "raw", "l0", "department_fallback", "none"


def _have(df: DataFrame, name: str | None, kind: str = "string") -> Column:
    return F.col(name) if name and name in df.columns else F.lit(None).cast(kind)


def l0_clean(df: DataFrame, config: CatalogConfig) -> DataFrame:
    """Adds the rule-cleaned columns to a raw catalog."""
    out = df.withColumns(
        {
            "title_raw": F.col(config.title),
            "title_normalized_l0": text.normalize_title(F.col(config.title)),
            "upc_clean_l0": text.clean_upc(_have(df, config.upc).cast("string")),
            "brand_raw": _have(df, config.brand),
            "category_raw": _have(df, config.category),
            "side": F.lit(config.side),
            "product_id": F.col(config.product_id),
        }
    )
    title = F.col("title_normalized_l0")
    out = out.withColumns({"has_upc_l0": F.col("upc_clean_l0").isNotNull(), "size_value_raw_l0": sizes.parsed_value(title), "size_unit_raw_l0": sizes.parsed_unit(title)})
    value, unit = F.col("size_value_raw_l0"), F.col("size_unit_raw_l0")
    return out.withColumns(
        {**{f"size_{k}_l0": sizes.normalized_size(value, unit, k) for k in ("ml", "g", "count")}, "size_unit_norm_l0": sizes.normalized_unit(unit)}
    )


def department_of(df: DataFrame) -> Column:
    """The department column; the raw category only where a table has no department at all."""
    return _have(df, "department" if "department" in df.columns else "category_raw")


def needs_model(df: DataFrame, skip_simple_rows: bool = True) -> Column:
    """Whether a row is hard: brand or department blank. All rows are if simple ones are not skipped."""
    if not skip_simple_rows:
        return F.lit(True)
    return text.is_blank(_have(df, "brand_raw")) | text.is_blank(department_of(df))


def _record(df: DataFrame, **given: Column) -> dict[str, Column]:
    base = {
        "brand": F.lit("UNKNOWN"), "brand_confidence": F.lit("low"), "is_private_label_llm": F.lit(None).cast("boolean"),
        "product_core": F.lit("UNKNOWN"), "product_core_confidence": F.lit("low"), "flavor": F.lit("NONE"), "flavor_confidence": F.lit("low"),
        "category_lvl1": F.lit(taxonomy.UNKNOWN), "category_lvl1_confidence": F.lit("low"), "category_lvl2": F.lit("NONE"), "category_lvl2_confidence": F.lit("low"),
        "notes": F.lit(""), **{c: F.col(f"{c}_l0") for c in REPLY_SIZE}, "size_confidence": F.lit(None).cast("string"),
    }
    return base | given


def l1_fallback(easy: DataFrame) -> DataFrame:
    """Easy rows with the record that stands for a reply."""
    brand, category = text.strip(_have(easy, "brand_raw")), taxonomy.map_department(department_of(easy))
    named = F.coalesce(brand, F.lit("")) != ""
    return easy.withColumns(
        _record(
            easy,
            brand=F.when(named, brand).otherwise(F.lit("UNKNOWN")),
            brand_confidence=F.when(named & (brand != "UNKNOWN"), F.lit("medium")).otherwise(F.lit("low")),
            is_private_label_llm=_have(easy, "is_private_label", "boolean"),
            category_lvl1=category,
            category_lvl1_confidence=F.when(category != taxonomy.UNKNOWN, F.lit("medium")).otherwise(F.lit("low")),
            notes=F.lit(EASY),
        )
    )


def l1_decode(hard: DataFrame, reply: str = "reply") -> DataFrame:
    """Hard rows with the record read from stored replies: no reply, or none that is an object, gives the error record."""
    v = F.try_parse_json(F.col(reply))
    good = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    value = lambda name, kind: F.try_variant_get(v, f"$.{name}", kind)
    error = _record(hard, notes=F.when(F.col(reply).isNull(), F.lit(NO_REPLY)).otherwise(F.lit(BAD_REPLY)))
    read = {n: value(n, "string") for n in (*REPLY_TEXT, "size_confidence")} | {n: value(n, "double") for n in REPLY_SIZE} | {"is_private_label_llm": value("is_private_label", "boolean")}
    return hard.withColumns({c: F.when(good, read[c]).otherwise(error[c]) for c in error})


def decode_record(reply: str | None) -> dict | None:
    """What l1_decode reads, in Python: an object or None."""
    try:
        found = json.loads(reply or "")
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def l1_clean(df: DataFrame, replies: DataFrame, id_col: str = "bb_id", skip_simple_rows: bool = True) -> DataFrame:
    """Easy rows with fallback records, hard rows with their replies (id, reply): one row for each input row.

    Of several replies to an id one that is not null counts: the latest by asked_at where the table has that column.
    """
    hard = F.coalesce(needs_model(df, skip_simple_rows), F.lit(True))
    one = latest(replies, [id_col], at="asked_at" if "asked_at" in replies.columns else None)
    asked = df.where(hard).join(one, id_col, "left")
    return l1_fallback(df.where(~hard)).unionByName(l1_decode(asked).drop("reply"))


def clean_prompt(df: DataFrame, side: str, product_id: str = "bb_id") -> Column:
    """What a model is asked about a hard row."""
    fields = [c for c in ("title_normalized_l0", "title_raw", "brand_raw", "department", "category_raw", "description", "permanent_tags", "is_private_label", "is_fresh", "size_value_raw_l0", "size_unit_raw_l0", "size_ml_l0", "size_g_l0", "size_count_l0", "size_unit_norm_l0") if c in df.columns]
    payload = F.to_json(F.struct(F.col(product_id).cast("string").alias("product_id"), F.lit(side).alias("side"), *fields), {"ignoreNullFields": "false"})
    return F.concat(F.lit(CLEAN_ASK[0]), payload, F.lit(CLEAN_ASK[1]))


def _reliable(confidence: Column) -> Column:
    return F.lower(F.coalesce(confidence, F.lit("low"))).isin(*RELIABLE)


def _pair(value: Column, source: str) -> Column:
    return F.struct(value.alias("value"), F.lit(source).alias("source"))


def fuse_brand(brand: Column, confidence: Column, raw: Column) -> Column:
    good = _reliable(confidence) & ~text.is_blank(brand) & (F.upper(text.strip(brand)) != "UNKNOWN")
    return F.when(good, _pair(text.strip(brand), MODEL)).when(~text.is_blank(raw), _pair(text.strip(raw), RAW)).otherwise(_pair(F.lit("UNKNOWN"), NOTHING))


def fuse_core(core: Column, confidence: Column) -> Column:
    good = _reliable(confidence) & ~text.is_blank(core) & (F.upper(text.strip(core)) != "UNKNOWN")
    return F.when(good, _pair(text.strip(core), MODEL)).otherwise(_pair(F.lit("UNKNOWN"), NOTHING))


def fuse_flavor(flavor: Column, confidence: Column) -> Column:
    good = _reliable(confidence) & ~text.is_blank(flavor) & (F.upper(text.strip(flavor)) != "NONE")
    return F.when(good, _pair(text.strip(flavor), MODEL)).otherwise(_pair(F.lit("NONE"), NOTHING))


def fuse_category(lvl1: Column, confidence: Column, lvl2: Column, department: Column) -> Column:
    """struct(lvl1, lvl2, source)."""
    good = _reliable(confidence) & ~text.is_blank(lvl1) & (text.strip(lvl1) != taxonomy.UNKNOWN)
    second = F.when(text.is_blank(lvl2), F.lit("NONE")).otherwise(text.strip(lvl2))
    three = lambda a, b, s: F.struct(a.alias("lvl1"), b.alias("lvl2"), F.lit(s).alias("source"))
    return F.when(good, three(text.strip(lvl1), second, MODEL)).otherwise(three(taxonomy.map_department(department), F.lit("NONE"), DEPARTMENT))


def fuse_size(model: dict[str, Column], confidence: Column, rules: dict[str, Column]) -> Column:
    """struct(ml, g, count, source): a dimension from the model if it is sure, else from the rules."""
    sure = F.lower(F.coalesce(confidence, F.lit(""))) == "high"
    told = {k: F.when(sure, model[k].try_cast("double")) for k in ("ml", "g", "count")}
    known = {k: rules[k].try_cast("double") for k in told}
    any_of = lambda cols: F.coalesce(*cols.values()).isNotNull()
    source = F.when(any_of(told), F.lit(MODEL)).when(any_of(known), F.lit(RULES)).otherwise(F.lit(NOTHING))
    return F.struct(*[F.coalesce(told[k], known[k]).alias(k) for k in told], source.alias("source"))


def l2_clean(df: DataFrame) -> DataFrame:
    """Adds the *_final columns and where each comes from."""
    c = F.col
    fused = df.withColumns(
        {
            "_brand": fuse_brand(c("brand"), c("brand_confidence"), c("brand_raw")),
            "_core": fuse_core(c("product_core"), c("product_core_confidence")),
            "_flavor": fuse_flavor(c("flavor"), c("flavor_confidence")),
            "_category": fuse_category(c("category_lvl1"), c("category_lvl1_confidence"), c("category_lvl2"), department_of(df)),
            "_size": fuse_size({k: c(f"size_{k}") for k in ("ml", "g", "count")}, c("size_confidence"), {k: c(f"size_{k}_l0") for k in ("ml", "g", "count")}),
        }
    )
    return fused.withColumns(
        {
            "brand_final": c("_brand.value"), "brand_final_source": c("_brand.source"),
            "product_core_final": c("_core.value"), "product_core_final_source": c("_core.source"),
            "flavor_final": c("_flavor.value"), "flavor_final_source": c("_flavor.source"),
            "category_lvl1_final": c("_category.lvl1"), "category_lvl2_final": c("_category.lvl2"), "category_final_source": c("_category.source"),
            "size_ml_final": c("_size.ml"), "size_g_final": c("_size.g"), "size_count_final": c("_size.count"), "size_final_source": c("_size.source"),
        }
    ).drop("_brand", "_core", "_flavor", "_category", "_size")


def with_embedding_text(df: DataFrame) -> DataFrame:
    """Adds text_for_embedding: the normalised title, else the raw one, and the fused attributes."""
    c = F.col
    title = F.when(~text.is_blank(c("title_normalized_l0")), c("title_normalized_l0")).otherwise(F.coalesce(c("title_raw"), F.lit("")))
    size = text.size_display(c("size_ml_final"), c("size_g_final"), c("size_count_final"))
    return df.withColumn("text_for_embedding", text.embedding_text(title, c("brand_final"), c("product_core_final"), c("flavor_final"), size, c("category_lvl1_final")))
