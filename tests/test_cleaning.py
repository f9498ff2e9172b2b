import json

import pytest
from pyspark.sql import functions as F

from matchwright.functions import sizes, taxonomy, text
from matchwright.operators import cleaning
from matchwright.plans.policy import CatalogConfig
from matchwright.sources import catalog, clients


def column(spark, values, make, kind="string"):
    rows = [(k, v) for k, v in enumerate(values)]
    return [r.x for r in spark.createDataFrame(rows, f"k int, v {kind}").select("k", make(F.col("v")).alias("x")).orderBy("k").collect()]


def test_titles(spark):
    assert column(spark, ["  A\t b  C ", None, "", " X y"], text.normalize_title) == ["a b c", "", "", "x y"]
    once = text.normalize_title(F.col("v"))
    assert column(spark, [" A  B "], lambda c: text.normalize_title(once)) == ["a b"]


def test_codes(spark):
    assert column(spark, ["0-12 x", "abc", None, "", "007"], text.clean_upc) == ["012", None, None, None, "007"]


@pytest.mark.parametrize(
    "title,value,unit",
    [
        ("coke 12 fl oz", 12.0, "fl"), ("7up 12 oz", 7.0, "up"), ("6 x 12 oz", 6.0, "x"), ("1,000 ml", 0.0, "ml"), (".5 l", 5.0, "l"),
        ("1.5.2 oz", 5.2, "oz"), ("12-pack soda 355ml", 355.0, "ml"), ("milk 2% 1 gal", 1.0, "gal"), ("plain", None, None), (None, None, None),
    ],
)
def test_sizes_in_titles(spark, title, value, unit):
    assert column(spark, [title], sizes.parsed_value) == [value] and column(spark, [title], sizes.parsed_unit) == [unit]


def test_units(spark):
    rows = [(2.0, u) for u in ("ml", "L", "lt", "kg", "oz", "lbs", "ct", "liters", "fl", None)]
    df = spark.createDataFrame(rows, "v double, u string")
    got = df.select(*[sizes.normalized_size(F.col("v"), F.col("u"), k).alias(k) for k in ("ml", "g", "count")], sizes.normalized_unit(F.col("u")).alias("kind")).collect()
    assert [tuple(r) for r in got] == [
        (2.0, None, None, "ml"), (2000.0, None, None, "ml"), (2000.0, None, None, "ml"), (None, 2000.0, None, "g"), (None, 2 * 28.3495, None, "g"),
        (None, 2 * 453.592, None, "g"), (None, None, 2.0, "count"), (None,) * 4, (None,) * 4, (None,) * 4,
    ]


def test_departments(spark):
    cases = {"Frozen Meat": "meat", "non-alcohol drinks": "alcohol", "carpet": "pet", "": "pantry", "  ": "pantry", None: "other_unknown", "Dairy & Eggs": "dairy"}
    assert column(spark, list(cases), taxonomy.map_department) == list(cases.values())


def test_missing_words(spark):
    values = ["unknown", " None ", "NONE", "other_unknown", None, " ", "x"]
    assert column(spark, values, text.is_missing) == [True, True, True, False, True, True, False]


def test_size_display(spark):
    rows = [(355.0, None, 12.0), (None, 12.5, None), (None, None, None), (1.0000001, None, None)]
    df = spark.createDataFrame(rows, "ml double, g double, n double").select(text.size_display(F.col("ml"), F.col("g"), F.col("n")).alias("x"))
    assert [r.x for r in df.collect()] == ["12 count, 355 ml", "12.5 g", "", "1 ml"]


def test_tokens(spark):
    assert column(spark, ["", None, "a b  a"], lambda c: F.size(text.tokens(c))) == [0, 0, 2]
    df = spark.createDataFrame([("", ""), ("a b", "b  c")], "a string, b string").select(text.title_overlap(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in df.collect()] == [0, 1]


def test_absent_columns_give_nulls(spark):
    out = cleaning.l0_clean(spark.createDataFrame([(1, " Tea 100 ML ")], "bb_id long, name string"), CatalogConfig("B")).first()
    assert (out.side, out.product_id, out.upc_clean_l0, out.has_upc_l0, out.brand_raw, out.category_raw, out.size_ml_l0) == ("B", 1, None, False, None, None, 100.0)


def test_department_falls_back_by_column_not_by_value(spark):
    both = spark.createDataFrame([(None, "Meat")], "department string, category_raw string")
    one = spark.createDataFrame([("Meat",)], "category_raw string")
    assert both.select(cleaning.department_of(both).alias("x")).first().x is None and one.select(cleaning.department_of(one).alias("x")).first().x == "Meat"


def test_routing(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", " "), (None, None)], "brand_raw string, department string")
    assert [r.x for r in df.select(cleaning.needs_model(df).alias("x")).collect()] == [False, True, True, True]
    assert [r.x for r in df.select(cleaning.needs_model(df, False).alias("x")).collect()] == [True] * 4


def full(spark, reply, **more):
    row = {"bb_id": 1, "name": "tea 100 ml", "upc_raw": "1", "brand_raw": None, "department": "Dairy", "is_private_label": False} | more
    df = spark.createDataFrame([tuple(row.values())], "bb_id long, name string, upc_raw string, brand_raw string, department string, is_private_label boolean")
    replies = spark.createDataFrame([(1, reply)], "bb_id long, reply string")
    return cleaning.l2_clean(cleaning.l1_clean(cleaning.l0_clean(df, CatalogConfig("A")), replies)).first()


def test_fusion(spark):
    good = {"brand": " Acme ", "brand_confidence": "High", "product_core": "tea", "product_core_confidence": "low", "flavor": "none", "flavor_confidence": "high", "category_lvl1": "snacks", "category_lvl1_confidence": "medium", "category_lvl2": "", "size_ml": 90, "size_confidence": "high"}
    r = full(spark, json.dumps(good))
    assert (r.brand_final, r.brand_final_source, r.product_core_final, r.flavor_final, r.category_lvl1_final, r.category_lvl2_final) == ("Acme", "gpt", "UNKNOWN", "NONE", "snacks", "NONE")
    assert (r.size_ml_final, r.size_final_source) == (90.0, "gpt")
    r = full(spark, json.dumps(good | {"size_ml": "x", "brand": "unknown", "category_lvl1": "other_unknown"}))
    assert (r.size_ml_final, r.size_final_source, r.brand_final, r.brand_final_source) == (100.0, "l0", "UNKNOWN", "none")
    assert (r.category_lvl1_final, r.category_final_source) == ("dairy", "department_fallback")


@pytest.mark.parametrize("reply,note", [(None, "GPT_API_ERROR"), ("not json", "GPT_JSON_PARSE_ERROR"), ("[1]", "GPT_JSON_PARSE_ERROR"), ("3", "GPT_JSON_PARSE_ERROR")])
def test_bad_replies(spark, reply, note):
    r = full(spark, reply)
    assert (r.notes, r.brand, r.size_ml, r.is_private_label_llm) == (note, "UNKNOWN", 100.0, None) and cleaning.decode_record(reply) is None


def test_easy_rows(spark):
    r = full(spark, None, brand_raw=" B ", is_private_label=True)
    assert (r.notes, r.brand, r.brand_confidence, r.category_lvl1, r.is_private_label_llm, r.brand_final_source) == ("SKIPPED_GPT_EASY_ROW", "B", "medium", "dairy", True, "gpt")


def test_embedding_text(spark):
    rows = [("tea", "raw", "Acme", "UNKNOWN", "none", 100.0, None, None, "other_unknown"), ("", "Raw T", "NONE", "x", "y", None, None, None, None)]
    df = spark.createDataFrame(rows, "title_normalized_l0 string, title_raw string, brand_final string, product_core_final string, flavor_final string, size_ml_final double, size_g_final double, size_count_final double, category_lvl1_final string")
    got = [r.text_for_embedding for r in cleaning.with_embedding_text(df).collect()]
    assert got == ["tea, brand: Acme, size: 100 ml, category: other_unknown", "Raw T, core: x, flavor: y"]


def test_catalog_files(spark, tmp_path):
    a = str(tmp_path / "a.csv")
    with open(a, "w") as f:
        f.write('bb_id,name,upc_raw,other\n1,"Tea, green",0012,x\n2,NONE,,y\n')
    df, _ = catalog.load_data(spark, a, a)
    rows = {r.bb_id: r for r in df.collect()}
    assert (rows[1].name, rows[1].upc_raw, rows[2].name, rows[2].upc_raw) == ("Tea, green", "0012", "NONE", None)
    catalog.write_csv(df, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2
    catalog.write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).columns == df.columns
    catalog.write_jsonl(df, str(tmp_path / "j"))
    assert sorted(map(tuple, catalog.read_jsonl(spark, str(tmp_path / "j"), df.schema).collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError, match="lacks the columns"):
        catalog.require_columns(df, ["nope"])


def test_vector_files(spark, tmp_path):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 2.0])], "bb_id long, embedding array<double>")
    path = str(tmp_path / "v")
    catalog.write_vectors(df, path, "bb_id", "embedding")
    assert sorted(map(tuple, catalog.read_vectors(spark, path, df, "bb_id").collect())) == [(1, [0.6, 0.8]), (2, [0.0, 1.0])]
    with pytest.raises(ValueError, match="2 vectors for 1 products"):
        catalog.read_vectors(spark, path, df.limit(1), "bb_id")


def test_clients(spark, tmp_path):
    cfg = tmp_path / "c.yaml"
    cfg.write_text("other: 1\nopenai:\n  endpoint: 'https://x.invalid/a'\n  api_key: k # secret\n  deployment_name: \"d\"\n")
    assert clients.read_credentials(str(cfg)) == ("https://x.invalid/a", "k", "d")
    cfg.write_text("openai:\n  endpoint: e\n")
    with pytest.raises(ValueError, match="api_key"):
        clients.read_credentials(str(cfg))

    def factory():
        def answer(prompt):
            if prompt == "b":
                raise RuntimeError("down")
            return prompt.upper()

        return answer

    df = spark.createDataFrame([("a",), ("b",), ("c",)], "prompt string")
    assert {r.prompt: r.reply for r in clients.ask(df, "prompt", "reply", factory).collect()} == {"a": "A", "b": None, "c": "C"}
    got = spark.createDataFrame([("tea",), (None,)], "t string").select(clients.embed(F.col("t")).alias("e")).collect()
    assert all(len(r.e) == 64 for r in got)
