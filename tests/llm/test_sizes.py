"""What must hold on tables larger than those of the other tests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchwright.llm import ngram_join as nj


def near_copies(spark, n=60, parts=3):
    """Families about one passage: some members link, most share half of it."""
    rng = np.random.default_rng(5)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    passage = word(500)
    rows = [(i, " ".join(passage + word(int(rng.integers(20, 700))))) for i in range(n)]
    rows += [(1000 + i, " ".join(passage[:250] + word(40))) for i in range(n)]
    rows += [(2000, None), (2001, ""), (2002, "one two"), (2003, "one two")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).checkpoint()


def named(spark, df):
    return {r.id: (r.n_shingles, r.component_id) for r in nj.classes(df).collect()}


@pytest.mark.parametrize("few,rows", [(10**6, 2_000_000), (10**6, 0), (0, 0)])
def test_sketches_and_wanted_texts_lose_no_link(spark, monkeypatch, few, rows):
    df = near_copies(spark)
    want = named(spark, df)
    assert len({c for _, c in want.values()}) < len(want) - 5
    monkeypatch.setattr(nj, "FEW", few)
    monkeypatch.setattr(nj, "BROADCAST_ROWS", rows)
    assert named(spark, df) == want


def test_sketches_keep_what_links_and_drop_what_does_not(spark):
    df = near_copies(spark)
    docs = df.select(F.monotonically_increasing_id().alias(nj.ROW), "doc_id", "text").where("doc_id < 2000").checkpoint()
    sets = {r[0]: set(zip(*[r[1].split()[k:] for k in range(5)])) for r in docs.select(nj.ROW, "text").collect()}
    x = docs.select(F.col(nj.ROW).alias("a"))
    pairs = x.crossJoin(x.withColumnRenamed("a", "b")).where("a < b")
    got = {(r.a, r.b) for r in nj._thinned(pairs, docs, docs, 5, 75).collect()}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert links and links <= got
    assert len(got) < len(links) + 0.1 * pairs.count()
    rows = spark.createDataFrame([(a,) for a in list(sets)[:7]], f"{nj.ROW} long")
    assert {r[0] for r in nj._wanted(docs, rows).select(nj.ROW).collect()} == set(list(sets)[:7])
