"""Exact nearest vectors: for each left row the k right rows of largest cosine, ties by id.

The right side is written once. A small one, by its measured size, goes along with the tasks. A larger one is dealt into tiles:
each vector belongs to the nearest of some pivots, and ranges of (pivot, cosine to it, id) are the tiles, so that a tile holds
neighbours. A tile's centroid and radius, the widest angle to it, bound every cosine that a left vector can have there.

A left vector first meets the tile of the nearest centroid, which gives it k cosines; then only tiles whose bound
reaches the lowest of them. For that, left vectors are dealt into blocks of neighbours and tiles into parts. A task holds a block, with the k
nearest of each vector so far, and lets the wanted tiles of a part pass by in pieces: what it holds does not grow with the
sides, and a vector moves once for each block or part, not for each tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchwright.operators.staging import written

#: The right side goes along with the tasks up to this many vector elements (8 bytes each).
CARRIED = 500_000
#: Bytes of a tile; it grows where all centroids would take more than CENTROIDS bytes.
TILE, CENTROIDS = 8 << 20, 64 << 20
#: Bytes of a block of left vectors with what they found, of the tiles of a task, and of right vectors that are met at once.
BLOCK, PART, PIECE = 16 << 20, 64 << 20, 1 << 20
PIVOTS = 256
#: What rounding can take from a bound.
SLACK = 1e-7

PAIRS = "a_id long, b_id long, similarity double"


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=x.copy(), where=n > 0)


def matrix(col: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    return np.asarray(col.flatten()).reshape(len(col), d)


def best(a: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int, bar: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, id of b, cosine) of the k nearest: by cosine, then id; none below a row's bar. ids ascend."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    k = min(k, len(ids))
    step = min(256, max(8, 1_000_000 // max(1, len(b))))
    for start in range(0, len(a) if k else 0, step):
        sims = a[start : start + step] @ b.T
        low = np.full(len(sims), -np.inf) if bar is None else bar[start : start + step] - SLACK
        many = np.flatnonzero((sims >= low[:, None]).sum(axis=1) > k)  # the others are taken as they are
        if len(many):
            low[many] = np.maximum(low[many], np.partition(sims[many], len(ids) - k, axis=1)[:, len(ids) - k])
        row, col = np.nonzero(sims >= low[:, None])
        value = sims[row, col]
        order = np.lexsort((col, -value, row))
        row, col, value = row[order], col[order], value[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append((row[keep] + start, ids[col[keep]], value[keep]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))


def _pairs(a_ids: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[str, pa.Array]:
    return {"a_id": pa.array(a_ids[found[0]].astype(np.int64)), "b_id": pa.array(found[1].astype(np.int64)), "similarity": pa.array(found[2])}


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("a_id").orderBy(F.desc("similarity"), "b_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def sound(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v))


def dimension_of(right: DataFrame, vector_col: str) -> int:
    """The commonest length of the vectors, the shorter of two as common; 0 without vectors."""
    row = right.groupBy(F.size(vector_col).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return int(row.d) if row else 0


def check_dimension(df: DataFrame, vector_col: str, dimension: int, side: str) -> None:
    wrong = df.where(F.col(vector_col).isNotNull() & (F.size(vector_col) != dimension))
    if n := wrong.count():
        raise ValueError(f"{n} vectors of the {side} side have another length than {dimension}")


def topk(
    a: DataFrame, b: DataFrame, k: int, id_col: str = "bb_id", vector_col: str = "embedding", carried: int = CARRIED, tile: int = TILE, dimension: int | None = None, strict: bool = False
) -> DataFrame:
    """(a_id, b_id, similarity, rank): exactly min(k, right rows) for each left row.

    Vectors count if they have `dimension` elements (by default the commonest length of the right side), none null or NaN; others
    take no part, or with `strict` a length that differs raises. A zero vector has cosine 0 with all.
    """
    right = written(b.where(sound(F.col(vector_col))).select(F.col(id_col).cast("long").alias("r_id"), F.col(vector_col).cast("array<double>").alias("r_v")))
    d = dimension or dimension_of(right, "r_v")
    if not d:
        return a.sparkSession.createDataFrame([], PAIRS + ", rank int")
    if strict:
        check_dimension(b, vector_col, d, "right")
        check_dimension(a, vector_col, d, "left")
    right = right.where(F.size("r_v") == d)
    left = a.where(sound(F.col(vector_col)) & (F.size(vector_col) == d)).select(F.col(id_col).cast("long").alias("l_id"), F.col(vector_col).cast("array<double>").alias("l_v"))
    n = right.count()
    if n * d > carried:
        return ranked(_tiled(left, right, n, d, k, tile), k)
    got = right.orderBy("r_id").toArrow()
    ids, table = got.column("r_id").to_numpy(), unit(matrix(got.column("r_v"), d))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cols = _pairs(batch.column(0).to_numpy(), best(unit(matrix(batch.column(1), d)), table, ids, k))
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return ranked(left.mapInArrow(near, PAIRS), k)


def tiles_of(right: DataFrame, n: int, d: int, tile: int = TILE) -> DataFrame:
    """r_id, r_v (unit), tile: ranges of neighbours, written; each tile is a partition."""
    size = max(tile, -(-n * d * 8 * d * 8 // CENTROIDS))
    many = max(1, -(-n * d * 8 // size))
    drawn = right.orderBy(F.xxhash64("r_id"), "r_id").limit(PIVOTS).toArrow()
    pivots = unit(matrix(drawn.column("r_v"), d))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = unit(matrix(batch.column("r_v"), d))
                sims = v @ pivots.T
                own = sims.argmax(axis=1)
                flat = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * d, pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("r_id"), flat, pa.array(own), pa.array(sims[np.arange(len(v)), own])], names=["r_id", "r_v", "pivot", "near"])

    dealt = right.mapInArrow(keyed, "r_id long, r_v array<double>, pivot long, near double").repartitionByRange(many, "pivot", "near", "r_id")
    return written(dealt.select("r_id", "r_v", F.spark_partition_id().alias("tile")))


def _balls(tiles: DataFrame, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, unit centroid, cosine of the radius, whether it holds a zero vector) of each tile that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            v = np.concatenate([matrix(b.column("r_v"), d) for b in held])
            there = (v != 0).any(axis=1)
            c = unit(v.sum(axis=0, keepdims=True))
            low = float((v[there] @ c[0]).min()) if there.any() else 1.0
            yield pa.RecordBatch.from_arrays(
                [held[0].column("tile").slice(0, 1), pa.array([c[0].tolist()], pa.list_(pa.float64())), pa.array([low]), pa.array([not there.all()])], names=["tile", "c", "low", "zero"]
            )

    got = tiles.mapInArrow(run, "tile int, c array<double>, low double, zero boolean").orderBy("tile").toArrow()
    return got.column("tile").to_numpy(), matrix(got.column("c"), d), got.column("low").to_numpy(), got.column("zero").to_numpy()


def bounds(a: np.ndarray, centroids: np.ndarray, low: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """The largest cosine that each unit vector can have with a vector of each tile."""
    apart = np.arccos(np.clip(a @ centroids.T, -1, 1)) - np.arccos(np.clip(low, -1, 1))[None, :]
    most = np.cos(np.maximum(0, apart))
    return np.where(zero[None, :], np.maximum(most, 0), most) + SLACK


def _barred(left: DataFrame, tiles: DataFrame, d: int, k: int, tile: int) -> DataFrame:
    """l_id, l_v, home and bar, the k-th cosine in the home tile, of each left row (l_id, l_v, home); tiles go to blocks of them."""
    rows = max(1, tile // (8 * d))
    many = written(left.groupBy(F.col("home").alias("of")).agg(F.ceil(F.count(F.lit(1)) / rows).alias("blocks")))  # a row for each tile at most
    block = F.pmod(F.xxhash64("l_id"), F.col("blocks")).alias("block")
    cut = left.join(F.broadcast(many), F.col("home") == F.col("of")).select("l_id", "l_v", "home", block)
    sent = tiles.join(F.broadcast(many), F.col("tile") == F.col("of")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("of", "blocks")

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        bar = np.full(x.num_rows, -np.inf)
        if x.num_rows and y.num_rows >= k:
            row, _, value = best(matrix(x.column("l_v"), d), matrix(y.column("r_v"), d), np.arange(y.num_rows), k)
            np.minimum.at(bar := np.full(x.num_rows, np.inf), row, value)
        return x.select(["l_id", "l_v", "home"]).append_column("bar", pa.array(bar, pa.float64()))

    return cut.groupBy("home", "block").cogroup(sent.groupBy("tile", "block")).applyInArrow(meet, "l_id long, l_v array<double>, home int, bar double")


class Held:
    """A block of left vectors and the k nearest of each that have been met; vectors wait until they make a piece."""

    def __init__(self, k: int, balls: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.k, self.balls, self.left, self.wait, self.n = k, balls, [], [], 0

    def add(self, tile: int, ids: np.ndarray, v: np.ndarray, bar: np.ndarray) -> None:
        if tile < 0:
            self.left.append((ids, v, bar))
            return
        if self.left:
            self.ids, self.v, self.bar = (np.concatenate(x) for x in zip(*self.left))
            self.value, self.near = np.full((len(self.ids), self.k), -np.inf), np.full((len(self.ids), self.k), np.iinfo(np.int64).max)
            self.left = []
        self.wait.append((tile, ids, v))
        self.n += len(ids)
        if self.n * v.shape[1] * 8 >= PIECE:
            self.meet()

    def meet(self) -> None:
        if not self.wait:
            return
        number, centroids, low, zero = self.balls
        at = np.searchsorted(number, np.unique([t for t, _, _ in self.wait]))
        ids, v = (np.concatenate([w[i] for w in self.wait]) for i in (1, 2))
        self.wait, self.n = [], 0
        order = np.argsort(ids, kind="stable")
        bar = np.maximum(self.bar, self.value[:, -1])
        rows = np.flatnonzero((bounds(self.v, centroids[at], low[at], zero[at]) >= bar[:, None]).any(axis=1))
        if not len(rows):
            return
        row, near, value = best(self.v[rows], v[order], ids[order], self.k, bar[rows])
        row = rows[row]
        there = np.unique(row)  # what these rows had joins what they met
        row = np.concatenate([np.repeat(there, self.k), row])
        near, value = np.concatenate([self.near[there].ravel(), near]), np.concatenate([self.value[there].ravel(), value])
        order = np.lexsort((near, -value, row))
        row, near, value = row[order], near[order], value[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        self.near[row[keep], rank[keep]], self.value[row[keep], rank[keep]] = near[keep], value[keep]

    def found(self) -> Iterator[pa.RecordBatch]:
        self.meet()
        if not self.left:
            for start in range(0, len(self.ids), step := max(1, 200_000 // self.k)):
                value = self.value[start : start + step]
                row, rank = np.nonzero(value > -np.inf)
                cols = _pairs(self.ids[start : start + step], (row, self.near[start : start + step][row, rank], value[row, rank]))
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _tiled(left: DataFrame, right: DataFrame, n: int, d: int, k: int, tile: int) -> DataFrame:
    tiles = tiles_of(right, n, d, tile)
    balls = number, centroids, low, zero = _balls(tiles, d)

    def housed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = unit(matrix(batch.column("l_v"), d))
                flat = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * d, pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("l_id"), flat, pa.array(number[(v @ centroids.T).argmax(axis=1)].astype(np.int32))], names=["l_id", "l_v", "home"])

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, any_of = None, np.zeros(len(number), bool)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                block = batch.column("block")[0].as_py()  # a partition is a block
                any_of |= (bounds(matrix(batch.column("l_v"), d), centroids, low, zero) >= batch.column("bar").to_numpy()[:, None]).any(axis=0)
        if block is not None:
            to = number[any_of]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(to), block, np.int32)), pa.array(to.astype(np.int32))], names=["block", "to"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            block, part, at = (batch.column(c).to_numpy() for c in ("block", "part", "tile"))
            ids, v, bar = batch.column("id").to_numpy(), matrix(batch.column("v"), d), batch.column("bar").to_numpy(zero_copy_only=False)
            edge = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (part[1:] != part[:-1]) | (at[1:] != at[:-1])))
            for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(block)]):
                if now != (block[i], part[i]):
                    if held:
                        yield from held.found()
                    held, now = Held(k, balls), (block[i], part[i])
                held.add(int(at[i]), ids[i:j], v[i:j], bar[i:j])
        if held:
            yield from held.found()

    home = written(left.mapInArrow(housed, "l_id long, l_v array<double>, home int"))
    # blocks are ranges of neighbours, as tiles are; each row of a block has its vector and the k nearest
    blocks = max(1, -(-home.count() * 8 * (d + 2 * k) // BLOCK))
    block = _barred(home, tiles, d, k, tile).repartitionByRange(blocks, "home", "l_id").withColumn("block", F.spark_partition_id())
    block = written(block)
    # a task has a block and a part, the tiles of neighbouring numbers: a vector moves once for each part or block, not for each tile
    size = max(1, PART // max(1, n * d * 8 // max(1, len(number))))
    part = F.floor(F.col("tile") / size).cast("int").alias("part")
    met = written(block.mapInArrow(wanted, "block int, to int"))
    parts = met.select(F.col("block").alias("of"), F.floor(F.col("to") / size).cast("int").alias("part")).distinct()
    rows = block.join(parts, F.col("block") == F.col("of")).select("block", "part", F.lit(-1).alias("tile"), F.col("l_id").alias("id"), F.col("l_v").alias("v"), "bar")
    sent = tiles.join(met, F.col("tile") == F.col("to")).select("block", part, "tile", F.col("r_id").alias("id"), F.col("r_v").alias("v"), F.lit(None).cast("double").alias("bar"))
    return rows.unionByName(sent).repartition("block", "part").sortWithinPartitions("block", "part", "tile").mapInArrow(stream, PAIRS)
