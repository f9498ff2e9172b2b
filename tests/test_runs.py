"""What survives a break: the reply ledger, request budgets, encoder batches, index checks, kept stages, CSV splits."""

import json
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchwright.operators import cleaning, matching
from matchwright.operators.staging import fingerprint, read_note, write_note
from matchwright.plans import pipeline, runner
from matchwright.plans.policy import CatalogConfig, Policy
from matchwright.sources import catalog, clients, ledger


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---- ledger


def test_latest_reply_counts(spark):
    df = spark.createDataFrame([("a", None, 9.0), ("a", "x", 1.0), ("a", "y", 2.0), ("b", None, 1.0), ("b", None, 2.0), ("c", "z", 5.0), ("c", "z", 5.0)], "k string, reply string, t double")
    assert rows(ledger.latest(df, ["k"], at="t"), "k", "reply") == [("a", "y"), ("b", None), ("c", "z")]
    assert rows(ledger.latest(df, ["k"]), "k", "reply") == [("a", "y"), ("b", None), ("c", "z")]


def counting(folder):
    """A client that leaves a file for each request and fails for some prompts while a marker is there."""

    def factory():
        import os
        import uuid

        def answer(prompt):
            open(f"{folder}/{uuid.uuid4().hex}", "w").write(prompt)
            if os.path.exists(f"{folder}/broken") and prompt.endswith("7"):
                raise RuntimeError("no answer")
            return prompt.upper()

        return answer

    return factory


def requests(folder):
    return sorted(p.read_text() for p in folder.iterdir() if p.name != "broken")


def test_only_what_is_missing_is_asked(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    (calls / "broken").write_text("")
    path = str(tmp_path / "ledger")
    prompts = spark.createDataFrame([(i, f"p{i % 20}") for i in range(40)] + [(99, None)], "id long, prompt string").repartition(5)
    got = ledger.ask(prompts, path, counting(calls), waves=3)
    assert rows(got, "id", "reply") == sorted([(i, None if i % 20 in (7, 17) else f"P{i % 20}") for i in range(40)] + [(99, None)], key=repr)
    assert requests(calls) == sorted(f"p{i}" for i in range(20))  # equal prompts once
    (calls / "broken").unlink()
    again = ledger.ask(prompts, path, counting(calls), waves=2)
    assert rows(again, "id", "reply") == sorted([(i, f"P{i % 20}") for i in range(40)] + [(99, None)], key=repr)
    assert requests(calls) == sorted([f"p{i}" for i in range(20)] + ["p17", "p7"])
    assert again.count() == 41 and ledger.read(spark, path).count() == 22
    more = prompts.union(spark.createDataFrame([(50, "new")], "id long, prompt string"))
    assert rows(ledger.ask(more, path, counting(calls)).where("id >= 50"), "id", "reply") == [(50, "NEW"), (99, None)]
    assert len(requests(calls)) == 23


def test_unfinished_batch_does_not_count(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.append(spark.createDataFrame([("h", "kept")], "prompt_hash string, reply string"), path)
    broken = ledger.append(spark.createDataFrame([("h", "half"), ("g", "half")], "prompt_hash string, reply string"), path)
    (tmp_path / "ledger" / broken.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    assert rows(ledger.replies(spark, path), "prompt_hash", "reply") == [("h", "kept")]
    assert ledger.read(spark, str(tmp_path / "nowhere")).count() == 0


def test_repeated_replies_give_one_row_for_each_product(spark):
    """Null and repeated replies, as a resumed run leaves them."""
    raw = spark.createDataFrame([(1, "Tea 5 g", None, None), (2, "Milk", None, "dairy")], "bb_id long, name string, brand_raw string, department string")
    l0 = cleaning.l0_clean(raw, CatalogConfig("A"))
    replies = spark.createDataFrame([(1, None), (1, '{"brand":"Acme"}'), (1, '{"brand":"Acme"}'), (2, None), (2, None)], "bb_id long, reply string")
    out = cleaning.l1_clean(l0, replies)
    assert rows(out, "bb_id", "brand", "notes") == [(1, "Acme", None), (2, "UNKNOWN", "GPT_API_ERROR")]
    timed = replies.withColumn("asked_at", F.lit(1.0)).union(spark.createDataFrame([(1, '{"brand":"Zest"}', 2.0)], "bb_id long, reply string, asked_at double"))
    assert rows(cleaning.l1_clean(l0, timed), "bb_id", "brand") == [(1, "Zest"), (2, "UNKNOWN")]


def test_replies_for_a_side(spark, tmp_path):
    """Cleaning prompts through the ledger; the id column is the configured one."""
    raw = spark.createDataFrame([(1, "Tea 5 g", None, None), (2, "Milk", "Best", "dairy"), (3, "Soap", " ", "household")], "sku long, name string, brand_raw string, department string")
    config = CatalogConfig("B", product_id="sku")

    def client():
        return lambda prompt: json.dumps({"brand": "B" + json.loads(prompt.split("\n")[1])["product_id"], "brand_confidence": "high"})

    got = pipeline.ask_replies(raw, config, client, str(tmp_path / "ledger"), waves=2)
    assert rows(got.select("sku", F.get_json_object("reply", "$.brand").alias("b")), "sku", "b") == [(1, "B1"), (3, "B3")]
    out = pipeline.clean(raw, config, got)
    assert rows(out, "sku", "brand_final", "brand_final_source") == [(1, "B1", "gpt"), (2, "Best", "gpt"), (3, "B3", "gpt")]


def test_reviews_by_a_client(spark, tmp_path):
    band = spark.createDataFrame([(1, 2, "milk", "milk"), (1, 3, "milk", "beer")], "a_id long, b_id long, a_title_normalized_l0 string, b_title_normalized_l0 string")

    def client():
        return lambda prompt: '{"label": "exact", "score": 0.9}' if prompt.count("milk") == 2 else "no answer"

    got = matching.review_decode(pipeline.ask_reviews(band, client, str(tmp_path / "ledger")))
    assert rows(got, "a_id", "b_id", "gpt_label", "gpt_score") == [(1, 2, "exact", 0.9), (1, 3, "none", 0.0)]
    kept = spark.createDataFrame([(1, 2), (1, 3)], "a_id long, b_id long")
    twice = spark.createDataFrame([(1, 2, "none"), (1, 2, "exact"), (1, 3, "none"), (1, 3, "none")], "a_id long, b_id long, gpt_label string")
    assert rows(matching.final_matches(kept, twice), "a_id", "b_id") == [(1, 2)]


# ---- budgets


def test_bucket_spreads_requests():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    budget = clients.Budget(4.0, lambda: now[0], sleep)
    times = []
    for _ in range(9):
        budget.take()
        times.append(now[0])
    assert times == [k / 4 for k in range(9)]
    now[0] += 100  # what was saved up is a second's worth at most
    before = now[0]
    for _ in range(8):
        budget.take()
    assert now[0] - before == pytest.approx(1.0)


def test_bucket_of_many_threads():
    budget, done = clients.Budget(200.0), []
    start = time.monotonic()
    work = [threading.Thread(target=lambda: [(budget.take(), done.append(time.monotonic() - start)) for _ in range(10)]) for _ in range(8)]
    for t in work:
        t.start()
    for t in work:
        t.join()
    assert len(done) == 80 and max(done) >= 79 / 200 - 0.02


def test_four_tasks_share_a_limit(spark, tmp_path):
    """Requests of four tasks are counted together: never more than the limit allows up to any moment."""
    folder = str(tmp_path)

    def factory():
        import uuid

        def answer(prompt):
            open(f"{folder}/{uuid.uuid4().hex}", "w").write(repr(time.time()))
            return "ok"

        return answer

    df = spark.createDataFrame([(i, str(i)) for i in range(60)], "id long, prompt string")
    assert clients.ask(df, "prompt", "reply", factory, threads=6, tasks=4, per_second=40.0).where("reply = 'ok'").count() == 60
    times = sorted(float(p.read_text()) for p in tmp_path.iterdir())
    assert len(times) == 60
    for i, t in enumerate(times):
        for j in range(i + 1, len(times)):
            assert j - i <= 40 * (times[j] - t) + 4 * 10 + 4 + 1  # what the buckets hold, and one request under way for each
    assert times[-1] - times[0] >= (60 / 4 - 1 - 10) / 10


def test_failed_requests_are_sent_again(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        import os

        def answer(prompt):
            tries = len([n for n in os.listdir(folder) if n.startswith(prompt + "-")])
            open(f"{folder}/{prompt}-{tries}", "w").write("")
            if tries < int(prompt):
                raise OSError("busy")
            return f"after {tries}"

        return answer

    df = spark.createDataFrame([(str(i),) for i in range(5)], "prompt string")
    got = clients.ask(df, "prompt", "reply", factory, tasks=2, retries=2, back_off=0.01)
    assert rows(got, "prompt", "reply") == [("0", "after 0"), ("1", "after 1"), ("2", "after 2"), ("3", None), ("4", None)]


# ---- encoder batches


def test_texts_are_encoded_by_length():
    seen = []

    def encode(texts):
        seen.append([len(t.split()) for t in texts])
        return np.array([[float(len(t)), float(len(t.split()))] for t in texts], np.float32)

    texts = ["a b c d e f", "a", "", "a b", "x " * 50, "b", "a b c", "q r s t"]
    got = clients.by_length(texts, encode, 8)
    assert [v.tolist() for v in got] == [[len(t), len(t.split())] for t in texts]
    assert all(len(b) == 1 or len(b) * max(1, max(b)) <= 8 for b in seen) and seen == sorted(seen, key=max) and len(seen) < len(texts)
    assert clients.by_length([], encode, 8) == []


@pytest.mark.parametrize("window", [1, 3, 100])
def test_embedding_does_not_depend_on_windows(spark, window):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame([(i, "word " * (i * 7 % 23) + str(i)) for i in range(100)] + [(200, None)], "id long, t string").repartition(2)
        got = {r.id: r.e for r in df.select("id", clients.embed(F.col("t"), window=window, tokens=40).alias("e")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    plain = clients.hashing_encoder()
    assert len(got) == 101
    for i in range(100):
        assert got[i] == plain(["word " * (i * 7 % 23) + str(i)])[0].tolist()
    assert got[200] == plain([""])[0].tolist()


# ---- index, notes, catalog


def test_index_is_checked(spark, tmp_path):
    path = str(tmp_path / "index")
    ids = spark.createDataFrame([(i,) for i in range(50)], "bb_id long")
    vectors = ids.select("bb_id", F.array(F.lit(3.0), F.col("bb_id").cast("double") + 1).alias("embedding"))
    catalog.write_vectors(vectors, path, "bb_id", "embedding")
    assert catalog.read_vectors(spark, path, ids.union(ids), "bb_id", dimension=2).count() == 50
    with pytest.raises(ValueError, match="other products"):
        catalog.read_vectors(spark, path, ids.where("bb_id < 49"), "bb_id")
    with pytest.raises(ValueError, match="elements"):
        catalog.read_vectors(spark, path, ids, "bb_id", dimension=3)

    def refused(df, match):
        at = str(tmp_path / match.replace(" ", ""))
        catalog.write_vectors(df, at, "bb_id", "embedding")
        with pytest.raises(ValueError, match=match):
            catalog.read_vectors(spark, at, ids, "bb_id")

    refused(vectors.where("bb_id <> 7").union(vectors.where("bb_id = 8")), "other products")  # a duplicate and a gap
    refused(vectors.withColumn("embedding", F.when(F.col("bb_id") == 3, F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.col("embedding"))), "norms")
    refused(vectors.withColumn("embedding", F.when(F.col("bb_id") == 3, F.array(F.lit(1.0))).otherwise(F.col("embedding"))), "elements")
    vectors.limit(50).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="not the index"):
        catalog.read_vectors(spark, path, ids, "bb_id")


def test_notes_and_fingerprints(spark, tmp_path):
    at = str(tmp_path / "note.json")
    assert read_note(spark, at) is None
    for note in ({"a": 1}, {"a": [2, "é"]}):
        write_note(spark, at, note)
        assert read_note(spark, at) == note
    df = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "a long, b string")
    assert fingerprint(df) == fingerprint(df.repartition(3)) != fingerprint(df.distinct())
    assert fingerprint(df.limit(0)) == {"rows": "0", "sum": "0", "xor": "0"}


def test_catalog_files(spark, tmp_path):
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text('bb_id,"name",upc_raw,"odd, column"\n1,"Tea, ""green""",007,x\n2,,08,y\n')
    broken.write_text('bb_id,name\n1,"two\nlines"\n2,b\n')
    assert not catalog.spans_lines(spark, str(plain)) and catalog.spans_lines(spark, str(broken))
    one = catalog.read_catalog(spark, str(plain))
    assert one.columns == ["bb_id", "name", "upc_raw", "odd, column"]
    assert rows(one, "bb_id", "name", "upc_raw") == [(1, 'Tea, "green"', "007"), (2, None, "08")]
    assert rows(catalog.read_catalog(spark, str(broken)), "bb_id", "name") == [(1, "two\nlines"), (2, "b")]
    many = tmp_path / "many.csv"
    many.write_text("bb_id,name\n" + "".join(f"{i},name {i}\n" for i in range(50_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        split = catalog.read_catalog(spark, str(many))
        assert split.rdd.getNumPartitions() > 4 and split.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# ---- kept stages


def parts(spark):
    kind = "bb_id long, embedding array<double>, brand_final string, category_lvl1_final string, size_ml_final double"
    rng = np.random.default_rng(0)
    make = lambda start: spark.createDataFrame([(start + k, rng.normal(size=4).tolist(), "x", "c", float(1 + k % 3)) for k in range(12)], kind)
    return make(0), make(100)


def test_stages_are_read_again(spark, tmp_path):
    a, b = parts(spark)
    policy = Policy(k=5, min_score=0.2, min_embedding=0.1, band=(0.0, 2.0), number="double")
    review = lambda band: band.withColumn("gpt_label", F.when(F.col("a_id") % 2 == 0, "none").otherwise("exact"))

    def run(policy, review=review, name="one"):
        made = runner.Runner(spark, str(tmp_path / "stages"))
        out = runner.match(made, made.source(a), made.source(b), policy, review, review_name=name)
        return rows(out.df, "bb_id_A", "bb_id_B"), {n: how for n, how, _ in made.log}, made.log

    first, how, log = run(policy)
    assert set(how.values()) == {"run"} and first == rows(pipeline.match(a, b, policy, review), "bb_id_A", "bb_id_B") != []
    assert [n for n, _, _ in log] == ["candidates", "scores", "matches", "reviews", "final"] and log[0][2] == 60
    again, how, _ = run(policy)
    assert again == first and set(how.values()) == {"read"}
    changed = Policy(k=5, min_score=0.5, min_embedding=0.4, band=(0.0, 2.0), number="double")
    third, how, _ = run(changed)
    assert how == {"candidates": "read", "scores": "read", "matches": "run", "reviews": "run", "final": "run"}
    assert third == rows(pipeline.match(a, b, changed, review), "bb_id_A", "bb_id_B")
    _, how, _ = run(policy, None)
    assert how == {"candidates": "read", "scores": "read", "matches": "read", "final": "run"}
    _, how, _ = run(policy, lambda band: band.withColumn("gpt_label", F.lit("exact")), "two")
    assert how["matches"] == "read" and how["reviews"] == "run"
    a = a.where("bb_id <> 3")
    _, how, _ = run(policy)
    assert set(how.values()) == {"run"}


def test_a_stage_that_broke_off_runs_again(spark, tmp_path):
    made = runner.Runner(spark, str(tmp_path))
    source = made.source(spark.range(5))

    def broken(df):
        return df.select(F.raise_error(F.lit("broke")).alias("x"))

    with pytest.raises(Exception, match="broke"):
        made.stage("one", [source], {}, broken)
    assert made.log == []
    assert made.stage("one", [source], {}, lambda df: df.where("id > 1")).df.count() == 3 and made.log == [("one", "run", 3)]


def test_cleaning_in_stages(spark, tmp_path):
    raw = spark.createDataFrame([(1, "Tea 5 g", None, None), (2, "Milk", "Best", "dairy")], "bb_id long, name string, brand_raw string, department string")
    replies = spark.createDataFrame([(1, '{"brand":"Acme","brand_confidence":"high"}')], "bb_id long, reply string")
    for want in ("run", "read"):
        made = runner.Runner(spark, str(tmp_path))
        out = runner.clean(made, made.source(raw), CatalogConfig("A"), made.source(replies))
        assert rows(out.df, "bb_id", "brand_final") == [(1, "Acme"), (2, "Best")]
        assert [(n, h) for n, h, _ in made.log] == [(f"{n}-A", want) for n in ("rules", "records", "fusion")]


def test_preview(spark):
    assert rows(matching.preview(spark.range(9).withColumnRenamed("id", "a_id")), "a_id") == [(i,) for i in range(5)]
