import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from matchwright.plans import oracles, registry
from matchwright.plans.policy import CatalogConfig
from matchwright.streaming import catalog_stream

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the shared tables are not here")


def shown(v):
    return repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = sorted(tuple(map(shown, r)) for r in df.select(*sorted(df.columns)).collect())
    want = duck.execute(oracles.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in sorted(names)]
    assert got == sorted(tuple(shown(r[i]) for i in order) for r in want.fetchall())


def test_registry_is_whole(spark):
    assert set(oracles.ORACLE_SQL) <= set(registry.QUERIES) <= set(entry.queries())
    assert set(registry.QUERIES) - set(oracles.ORACLE_SQL) == {"embed_text"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    assert registry.QUERIES["clean_prompt"](spark, SF).where("prompt is null").count() == 0
    assert registry.QUERIES["review_prompt"](spark, SF).where("prompt is null").count() == 0


def test_cosine_of_every_candidate(spark):
    a, b = registry.vector_sides(spark, SF)
    got = registry.QUERIES["cosine_pairs"](spark, SF).select("a_id", "b_id").distinct().count()
    assert got == registry.QUERIES["topk_candidates"](spark, SF).count() == a.count() * min(registry.FIXTURE.k, b.count())


def test_stream_equals_batch(spark, tmp_path):
    raw = registry.raw(spark, SF).drop("side")
    raw.write.json(str(tmp_path / "in"))
    config = CatalogConfig("A")
    query = catalog_stream.clean_stream(catalog_stream.read_listings(spark, str(tmp_path / "in"), raw.schema), config, str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    from matchwright.operators.cleaning import l0_clean

    want = l0_clean(raw, config)
    key = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(want)
