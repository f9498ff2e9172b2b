"""What the findings of round 3 were about: the cost of coding texts, what a worker holds, models of all documents."""

from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from matchwright.llm import common, packing, pii, suffix_dedup


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_coding_costs_little_beside_the_coder():
    coder = packing.Encoder(*packing.public_vocabulary())
    texts = [words(400, k) for k in range(600)]
    distinct = "".join(" " + w for w in sorted({w for t in texts for w in t.split(" ")[1:]}))
    raw, offsets = common.packed(pa.array(texts))

    def least(f) -> float:
        spent = []
        for _ in range(3):
            start = time.process_time()
            f()
            spent.append(time.process_time() - start)
        return min(spent)

    assert least(lambda: coder.encode(raw, offsets)) < 2.4 * least(lambda: coder.coder.encode_ordinary(distinct))


def test_coded_texts_are_those_of_the_coder():
    coder = packing.Encoder(*packing.public_vocabulary())
    texts = ["", "a", " ", "  b", "b ", " c", "\n d  e  f", "  g", "é é \x7f \x00 \x01", "h" * 3000, "i  \n\n j", "", "k 1 22 333's", ""]
    ids, first = coder.encode(*common.packed(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [coder.coder.encode_ordinary(t) for t in texts]


def test_a_worker_holds_little_while_it_finds_anchors():
    texts = pa.array([words(1500, k) for k in range(800)])
    rows = pa.array(np.arange(len(texts)))
    batch = pa.RecordBatch.from_arrays([rows, rows, texts], names=[suffix_dedup.ROW, "id", "text"])
    sent = suffix_dedup._sent(16, suffix_dedup.LENGTH, suffix_dedup.GRAM, suffix_dedup.FLUSH)
    common.release()
    tracemalloc.start()
    try:
        for _ in sent(iter([batch])):
            pass
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()
    assert not common._POWERS  # nothing is kept for the next task


def letters(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    host = ["example.com", "mail.example.org", "post.example.net"]
    return [f"{words(4, k)} write to {words(1, -k)}.{words(1, k)}@{rng.choice(host)} {words(3, k)}" for k in range(n)]


def test_every_document_teaches(spark):
    """Addresses only in documents that a sample of 20,000 by hashes of ids would leave out."""
    ids = spark.range(45_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) >= int(20_000 / 45_000 * (1 << 30))).alias("out"))
    some = [r.id for r in ids.where("out").orderBy("id").limit(200).collect()]
    told = dict(zip(some, letters(200, 1)))
    docs = spark.createDataFrame([(k, told.get(k, "some words")) for k in range(45_000)], "doc_id long, text string").repartition(4)
    assert pii.fit(docs).bars[pii.EMAIL] < float("inf")


def test_trees_and_thresholds_are_the_same_from_jobs(spark):
    docs = spark.createDataFrame([(t,) for t in letters(300, 2)] + [(f"card 4{k:015d} ip 10.0.{k % 256}.7",) for k in range(300)], "text string").repartition(3)
    one, two = pii.fit(docs, rounds=3), pii.fit(docs, rounds=3, at_once=0)
    assert (one.trees.feature == two.trees.feature).all() and (one.trees.cut == two.trees.cut).all()
    np.testing.assert_allclose(one.trees.value, two.trees.value, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(one.bars, two.bars, rtol=1e-9)
    for a, b in zip(one.calibrated, two.calibrated):
        np.testing.assert_allclose(a.level, b.level)
