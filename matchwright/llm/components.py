"""Connected components of an edge relation by alternating large and small stars, with local contraction first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.common import cut, drop


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (member, least member) with the same components as the edges."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    parent = np.arange(len(nodes))
    while True:
        low = np.minimum(parent[a], parent[b])
        before = parent.copy()
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        if (parent == before).all():
            break
    far = parent != np.arange(len(nodes))
    return nodes[far], nodes[parent[far]]


def _contract(batches: Iterator[pa.RecordBatch], flush: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = np.append(u, batch.column(0).to_numpy()), np.append(v, batch.column(1).to_numpy())
        if len(u) > flush:
            u, v = forest(u, v)
            if len(u) > flush // 2:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                u, v = u[:0], v[:0]
    if len(u):
        u, v = forest(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (u long, v long); root is the least node of its component.

    A round is logarithmic in what remains of the longest path; contraction in each partition makes most edges stars at once.
    """
    now = cut(edges.where("u <> v").select("u", "v").mapInArrow(_contract, "u long, v long"))
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        after = cut(
            small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        )
        # done when every edge is (member, root): no node has two edges and no root is a member
        open_edges = after.join(after.select(F.col("u").alias("r")), F.col("v") == F.col("r"), "left_semi").limit(1)
        done = not open_edges.take(1) and not after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
        drop(now)
        now = after
        if done:
            break
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
