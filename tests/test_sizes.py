"""What must hold on tables larger than those of the other tests."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from matchwright.operators import nearest
from matchwright.sources import clients


def test_encoder_hashes_a_trigram_once(monkeypatch):
    texts = ["green tea 12 oz", "green tea 24 oz", "", "ab", "Käse \U0001f9c0 groß"] * 50
    want = np.zeros((len(texts), 64), np.float32)
    for k, text in enumerate(texts):
        for i in range(max(1, len(text) - 2)):
            h = int.from_bytes(hashlib.blake2b(text[i : i + 3].encode(), digest_size=8).digest(), "little")
            want[k, h % 64] += 1.0 if h >> 63 else -1.0
    calls, real = [], hashlib.blake2b
    monkeypatch.setattr(hashlib, "blake2b", lambda *a, **k: (calls.append(a), real(*a, **k))[1])
    encode = clients.hashing_encoder(64)
    assert (encode(texts) == want).all() and (encode(texts[::-1]) == want[::-1]).all()
    assert len(calls) == len(set(calls))
    monkeypatch.setattr(clients, "TRIGRAMS", 5)
    small = clients.hashing_encoder(64)
    assert all((small([t]) == want[k]).all() for k, t in enumerate(texts))
    assert encode([]).shape == (0, 64)


def test_vectors_do_not_move_for_each_tile(spark, monkeypatch):
    """Left vectors and tiles meet in blocks and parts: a left vector goes once to each part, whatever the tiles."""
    rng = np.random.default_rng(3)
    rows = lambda n, start: spark.createDataFrame([(start + i, rng.normal(size=8).tolist()) for i in range(n)], "bb_id long, embedding array<double>")
    a, b = rows(200, 0), rows(600, 1000)
    monkeypatch.setattr(nearest, "BLOCK", 100 * 8 * (8 + 10))
    plain = {(r.a_id, r["rank"]): r.b_id for r in nearest.topk(a, b, 5).collect()}
    found = nearest.topk(a, b, 5, carried=0, tile=1280)
    assert {(r.a_id, r["rank"]): r.b_id for r in found.collect()} == plain
    pairs = nearest._tiled(*[x.select(F.col("bb_id").alias(i), F.col("embedding").alias(v)) for x, i, v in ((a, "l_id", "l_v"), (b, "r_id", "r_v"))], 600, 8, 5, 1280)
    assert pairs.count() == 200 * 5  # before: what each of the 30 tiles found
