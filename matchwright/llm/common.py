"""Helpers that the corpus operators share: session settings, Arrow batches, and the blob exchange.

The blob exchange replaces row-per-item shuffles for hashes and positions: a map task packs the items of one bucket in
a single binary row, so that a shuffle of a billion hashes costs eight bytes each and the number of rows stays small.
"""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts write it: space, and tab to carriage return.
WS = r"[\x20\x09-\x0D]+"
MB = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Takes the folder of spark.checkpoint.dir; only a local master (tests) gets a temporary one where none is named."""
    if spark.sparkContext.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", "")
        if not where and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(where or tempfile.mkdtemp(prefix="checkpoint-"))


def free(name: str, columns: list[str]) -> str:
    """The name, with underscores after it until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Materialises in the shared checkpoint folder: lineage ends there and a lost executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop(df: DataFrame) -> None:
    """Deletes the files of a frame that cut() made and nothing reads any more."""
    held = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if held.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(held.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's own setting: exchanges of a finished job are deleted at once.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Deletes finished exchanges while steps run that each end in a checkpoint and are not run again."""
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def text_bytes(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of the text column): one pass over a single column, for sizing partitions."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"))).first()
    return int(row[0]), int(row[1] or 0)


def pieces(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-total // max(1, each)))


def sliced(batches: Iterator[pa.RecordBatch], text: str, most: int = 8 * MB) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `most` bytes of text (one longer text makes a batch of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def release() -> None:
    """Gives freed memory back: a worker that waits for its next task then holds little."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def packed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, offsets): null counts as empty."""
    col = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on an uint64 array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct values, first place of each, index of each key among them) of uint64 hashes.

    High bits and places are sorted as one number, which is several times as fast as an indirect sort; where the bits left out
    matter, the few places are put right afterwards.
    """
    n = len(keys)
    if not n or n >= 1 << 24:
        return np.unique(keys, return_index=True, return_inverse=True)
    low = np.uint64((1 << 24) - 1)
    both = (keys & ~low) | np.arange(n, dtype=np.uint64)
    both.sort()
    order, both = (both & low).astype(np.int64), both >> np.uint64(24)
    ks = keys[order]
    for at in np.flatnonzero(ks[1:] < ks[:-1]).tolist():
        i, j = np.searchsorted(both, both[at]), np.searchsorted(both, both[at], side="right")
        run = np.sort(order[i:j])
        order[i:j] = run[np.argsort(keys[run], kind="stable")]
        ks[i:j] = keys[order[i:j]]
    new = np.append(True, ks[1:] != ks[:-1])
    inverse = np.empty(n, np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ks[new], order[new], inverse


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse, modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = 1 << max(10, int(n).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        have = _POWERS[base] = (out[0], out[1])
    return have


BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class Rolling:
    """Hashes of any range of a byte array: polynomials modulo 2**64 of its blocks, each mixed with its place, and the length.

    A polynomial alone would not tell long patterns of Thue and Morse from their complements.
    """

    BLOCK = 256

    def __init__(self, data: np.ndarray, base: int = BASE_A) -> None:
        up, self.down = powers(base, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = stop - start
        if not len(size) or size.max() <= self.BLOCK:
            return mix((self.sums[stop] - self.sums[start]) * self.down[start] + mix(size.astype(np.uint64)))
        h, live, k = mix(size.astype(np.uint64)), np.arange(len(size)), 0
        while len(live):
            a = start[live] + k * self.BLOCK
            b = np.minimum(a + self.BLOCK, stop[live])
            part = (self.sums[b] - self.sums[a]) * self.down[a]
            h[live] += part if k == 0 else mix(part + np.uint64(k * BASE_A % (1 << 64)))
            k += 1
            live = live[size[live] > k * self.BLOCK]
        return mix(h)


def runs_of(outside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of the document) of the runs of bytes that are not `outside`; the end of a document ends a run."""
    gap = np.ones(len(outside) + 2, dtype=bool)
    gap[1:-1] = outside
    edge = np.diff(gap.astype(np.int8))
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(outside))])
    both = inner[~gap[inner] & ~gap[inner + 1]]
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(both):
        starts, ends = np.sort(np.concatenate([starts, both])), np.sort(np.concatenate([ends, both]))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, doc


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of the document) of the words: runs without the white space of WS."""
    return runs_of((raw == 32) | ((raw >= 9) & (raw <= 13)), offsets)


_KEPT = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_hashes(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: each eight-byte block is mixed with its place before the blocks are summed.

    No block enters linearly, so no pattern of equal blocks (as that of Thue and Morse, which cancels in a polynomial modulo
    2**64) makes two words alike.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    size = (stop - start).astype(np.int64)
    padded = np.append(raw, np.zeros(8, np.uint8))
    eight = np.ndarray((len(raw) + 1,), "<u8", padded.data, strides=(1,))
    blocks = np.maximum(1, -(-size // 8))
    first = np.cumsum(blocks) - blocks
    word = np.repeat(np.arange(len(start)), blocks)
    k = np.arange(len(word)) - first[word]
    at = start[word] + 8 * k
    value = eight[at] & _KEPT[np.minimum(8, stop[word] - at)]
    part = mix(mix(value) + (k + 1).astype(np.uint64) * np.uint64(BASE_A))
    return mix(np.add.reduceat(part, first) + mix(size.astype(np.uint64)))


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, other bytes as they are."""
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
