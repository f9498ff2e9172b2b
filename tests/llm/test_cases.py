"""Toxicity features against plain Python, and the pipeline and the registered queries on null ids, repeated rows and empty tables."""

import collections
import math
import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchwright.llm import exact_dedup, toxicity
from matchwright.llm.common import packed

SPACE = " \t\n\x0b\f\r"


def is_mark(c):
    return (not c.isalnum()) if ord(c) < 128 else unicodedata.category(c)[0] in "PSZ" or unicodedata.category(c) in ("Cc", "Cf")


def one_edit(a, b):
    """Whether two byte strings are at most one insertion, deletion or replacement apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def verdict(word, terms):
    w = word.lstrip("".join(sorted({c for c in word if is_mark(c)}))).encode()
    if any(w.startswith(t) for t in terms):
        return 2
    return int(any(len(t) >= toxicity.FUZZY_LEAST and any(one_edit(w[:k], t) for k in range(len(t) - 1, len(t) + 2) if k <= len(w)) for t in terms))


def plain_features(text, terms, window=toxicity.WINDOW):
    words = [w for w in "".join("\n" if c in SPACE else c for c in (text or "")).split("\n") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    v = [verdict(w, terms) for w in words]
    hits = [i for i, x in enumerate(v) if x]
    exact, near = v.count(2), v.count(1)
    dense = max((sum(1.0 if v[j] == 2 else 0.25 for j in hits if abs(i - j) <= window) for i in hits), default=0.0)
    out = [math.log1p(exact), math.log1p(near), min(1, 20 * (exact + 0.25 * near) / max(1, len(words))), math.log1p(dense)]
    return out, [float(exact > 0), float(near > 0 and exact == 0)]


def test_toxicity_features_against_plain_python():
    rng = random.Random(4)
    terms = [b"scum", b"vilest", b"grubby", "dégoût".encode()]
    auto = toxicity.build_automaton(sorted(terms))
    seeds = ["scum", "vilest", "grubby", "dégoût", "garden", "tea", "scam", "vilst", "grubbby", "viledt", "gubby", "cum", "vil"]

    def word():
        w = rng.choice(seeds)
        if rng.random() < 0.4:
            k = rng.randrange(len(w) + 1)
            w = rng.choice([w[:k] + rng.choice("abcé") + w[k:], w[: max(0, k - 1)] + w[k:], w.upper(), w + "ish"])
        return rng.choice(["", "", "“", "(", "«", "--", "…"]) + w + rng.choice(["", "", ".", "”", "?!"])

    texts = [rng.choice([" ", "\n"]).join(word() for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", "  ", "“”", "scum"]
    got = toxicity.features(auto, *packed(pa.array(texts)))
    for text, row in zip(texts, got):
        first, last = plain_features(text, terms)
        assert np.allclose(row[:4], first) and row[5:].tolist() == last, text


def test_scores_are_the_logistic_of_features():
    terms = [b"scum"]
    rng = np.random.default_rng(1)
    model = toxicity.Model(toxicity.build_automaton(terms), rng.normal(size=toxicity.FEATURES + 1), np.abs(rng.normal(size=toxicity.FEATURES)) + 0.5, terms)
    x = rng.normal(size=(20, toxicity.FEATURES))
    for row, s in zip(x, model.score(x)):
        z = model.weights[0] + sum(v / c * w for v, c, w in zip(row, model.scale, model.weights[1:]))
        assert math.isclose(s, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


ROWS = [
    (1, "green tea is good today and tomorrow too"), (1, "green tea is good today and tomorrow too"), (None, "green tea is good today and tomorrow too"), (None, None), (2, None),
    (3, ""), (3, ""), (4, "one two"), (5, "green tea is  good today\nand tomorrow too"), (6, "ONE TWO"), (None, "mail me at a.b@example.com"), (7, "z" * 500 + " " + "z" * 500),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("odd"))
    rows = [(i, t, "en", None if k % 3 else "s", len(t or "")) for k, (i, t) in enumerate(ROWS)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, "green tea"), (None, "one"), (1, "green tea")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return at


@pytest.mark.parametrize("name", ["op1_toxicity", "op2_two_pass_shuffle", "op4_line_dedup", "op5_exact_dedup", "op6_suffix_tree_lm", "op7_suffix_dedup", "op8_nbest_segmentation", "op9_ngram_join", "op10_quality_rules", "op13_personal_data"])
def test_null_ids_and_repeated_rows(spark, folder, name):
    """A row each, and for equal rows equal results but for what tells places apart."""
    rows = entry.queries()[name](spark, folder).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, _ in ROWS)


def test_null_ids_and_repeated_rows_in_pieces_and_lists(spark, folder):
    pieces = entry.queries()["op3_mixture_packing"](spark, folder).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in ROWS} and all(r.n > 0 for r in pieces)
    found = entry.queries()["op12_ranked_search"](spark, folder).collect()
    assert sorted(r["rank"] for r in found if r.item_id == 1) == sorted([*range(1, 5)] * 2)
    assert [r.doc_id for r in sorted(found, key=lambda r: r["rank"]) if r.item_id is None] == [4, 6]


def test_pipeline_on_odd_rows(spark, folder):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter(r.doc_id for r in out if r.start == 0) == {1: 1, 2: 1, 4: 1, 7: 1, None: 1}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_pipeline_on_no_rows(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_chunks_do_not_move(spark):
    """Verifying identifiers sends digests only, and finds those that stand for two chunks."""
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "".join(rng.choice("abcdef ") for _ in range(5000))) for i in range(60)], "doc_id long, text string")
    sent = exact_dedup.failed_identifiers(docs, digest=1)
    assert sent.count() > 0 and exact_dedup.failed_identifiers(docs).count() == 0
    assert [f.name for f in sent.schema] == ["chunk_id"] and "witness" in sent._jdf.queryExecution().toString()
