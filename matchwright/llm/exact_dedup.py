"""Exact de-duplication by content-defined chunk recipes.

Each text, with white space runs turned into single spaces, is cut where a rolling hash of its last 32 bytes has its
low bits zero, so equal passages are cut alike wherever they stand. A chunk's identifier is a short digest that is *verified*:
every task sends each distinct identifier once with a witness, the SHA-256 of the chunk's bytes, and an identifier that met
two witnesses is set aside. A document is then only its ordered list of identifiers, a few bytes for each kilobyte of text,
and equal lists are grouped; documents whose list holds an identifier that failed the check are grouped by the digest of
the whole text instead. Neither documents nor chunks move.

Cases: a null text counts as empty; empty texts equal one another; a long text is chunked whole. Of rows with the same text and the same id exactly
one is kept; a null id stands after every other id. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.common import MB, cut, free, packed, release, sliced

SPACES = bytes(32 if x == 32 or 9 <= x <= 13 else x for x in range(256))
BROADCAST_ROWS = 2_000_000  # 16 MB of row numbers
MIN_CHUNK, MASK_BITS, MAX_CHUNK, DIGEST = 256, 11, 16384, 16


def _gear() -> np.ndarray:
    return np.frombuffer(hashlib.shake_128(b"gear").digest(1024), dtype=np.uint32)


def normalised(text: bytes) -> bytes:
    text = text.translate(SPACES)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def cut_points(raw: np.ndarray) -> np.ndarray:
    """Where the rolling hash of the last 32 bytes allows a cut (after that byte)."""
    h = _gear()[raw]
    for shift in (1, 2, 4, 8, 16):
        moved = np.zeros_like(h)
        moved[shift:] = h[:-shift] << np.uint32(shift)
        h = h + moved
    return np.flatnonzero((h >> np.uint32(32 - MASK_BITS)) == 0) + 1


def chunk_ends(cuts: np.ndarray, start: int, stop: int) -> list[int]:
    """Ends of the chunks of [start, stop): cuts at least MIN_CHUNK apart, none longer than MAX_CHUNK."""
    ends, at = [], start
    for c in cuts[np.searchsorted(cuts, start + MIN_CHUNK) : np.searchsorted(cuts, stop)].tolist():
        while c - at > MAX_CHUNK:
            at += MAX_CHUNK
            ends.append(at)
        if c - at >= MIN_CHUNK:
            ends.append(c)
            at = c
    while stop - at > MAX_CHUNK:
        at += MAX_CHUNK
        ends.append(at)
    if stop > at:
        ends.append(stop)
    return ends


def chunked(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The chunks of each text, all texts hashed in one pass."""
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    whole = b"".join(texts)
    cuts = cut_points(np.frombuffer(whole, dtype=np.uint8)) if whole else np.zeros(0, np.int64)
    for i, text in enumerate(texts):
        base = int(offsets[i])
        ends = [e - base for e in chunk_ends(cuts, base, base + len(text))]
        yield [text[a:b] for a, b in zip([0, *ends], ends)]


def _digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=32).digest()[:size]


def _texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    raw, offsets = packed(batch.column(text))
    whole = raw.tobytes()
    return [normalised(whole[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: int = DIGEST, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, columns of `carry`, n_bytes, text_sha256, recipe): recipe holds the chunks' identifiers in order."""
    there = [id_col, *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, 4 * MB):
            texts = _texts(batch, text_col)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in there],
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                    pa.array([b"".join(_digest(c, digest) for c in chunks) for chunks in chunked(texts)], pa.binary()),
                ],
                names=[*there, "n_bytes", "text_sha256", "recipe"],
            )
            del batch, texts
        release()

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in there)
    return docs.select(*there, text_col).mapInArrow(run, f"{kinds}, n_bytes long, text_sha256 string, recipe binary")


def failed_identifiers(docs: DataFrame, text_col: str = "text", digest: int = DIGEST) -> DataFrame:
    """(chunk_id) of identifiers that stand for chunks of more than one SHA-256; none with a sound digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in sliced(batches, text_col, 4 * MB):
            ids, witnesses = [], []
            for found in chunked(_texts(batch, text_col)):
                for c in found:
                    witness = hashlib.sha256(c).digest()
                    if witness not in sent:  # otherwise the same went out from this task already
                        sent.add(witness)
                        ids.append(_digest(c, digest))
                        witnesses.append(witness)
            if len(sent) > 500_000:
                sent.clear()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(witnesses, pa.binary())], names=["chunk_id", "witness"])
            del batch, ids, witnesses
        del sent
        release()

    moved = docs.select(text_col).mapInArrow(run, "chunk_id binary, witness binary")
    return moved.groupBy("chunk_id").agg(F.min("witness").alias("a"), F.max("witness").alias("b")).where("a <> b").select("chunk_id")


def _keyed(rows: DataFrame, docs: DataFrame, text_col: str, digest: int) -> DataFrame:
    """Rows with their `key`: the recipe, or the digest of the whole text where an identifier in the recipe failed."""
    parts = F.expr(f"transform(sequence(1, cast(length(recipe) / {digest} as int)), i -> substring(recipe, (i - 1) * {digest} + 1, {digest}))")
    broken = (
        rows.where(F.length("recipe") > 0).select("recipe", F.explode(parts).alias("chunk_id"))
        .join(failed_identifiers(docs, text_col, digest), "chunk_id", "left_semi")
        .select("recipe", F.lit(True).alias("failed")).distinct()
    )
    whole = F.concat(F.lit("text:").cast("binary"), F.col("text_sha256").cast("binary"))
    return rows.join(broken, "recipe", "left").withColumn("key", F.when(F.col("failed"), whole).otherwise(F.col("recipe")))


def _met(rows: DataFrame, keys: DataFrame, by: str, how: str, salts: int) -> DataFrame:
    """Rows with what their key's group says: each group is there once for each salt, so a hot one is dealt over `salts` tasks."""
    keys = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).join(keys, ["key", "salt"], how)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: int = DIGEST, salts: int = 32) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, n_bytes."""
    made = recipes(docs, id_col, text_col, digest)
    rows = _keyed(made.groupBy(id_col, "n_bytes", "text_sha256", "recipe").agg(F.count(F.lit(1)).alias("times")), docs, text_col, digest)
    keys = rows.groupBy("key").agg(F.min(id_col).alias("keep_id"), F.sum("times").alias("group_size")).where("group_size > 1")
    each = _met(rows, keys, id_col, "left", salts).withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col(id_col)).otherwise(F.col("keep_id"))
    return each.select(
        id_col,
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col(id_col).eqNullSafe(keep) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
        "n_bytes",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: int = DIGEST, salts: int = 32) -> DataFrame:
    """The rows of `docs`, all columns, less those whose text an earlier row has: by id, a null id last, then by place in the scan.

    Only recipes and row numbers move; `docs` must be a table scan or otherwise stable.
    """
    row = free("_row", docs.columns)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = _keyed(recipes(numbered, id_col, text_col, digest, (row,)), docs, text_col, digest)
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")))
    keys = rows.groupBy("key").agg(first.alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1").select("key", F.col("first.row").alias("stays"))
    gone = cut(_met(rows, keys, row, "inner", salts).where(F.col(row) != F.col("stays")).select(row))
    if gone.count() <= BROADCAST_ROWS:  # otherwise rows meet their numbers in a shuffle
        gone = F.broadcast(gone)
    return numbered.join(gone, row, "left_anti").drop(row)


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from matchwright.llm.common import table

    return exact_dedup(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256, strlen(n.t) AS n_bytes
FROM n JOIN g ON n.t = g.t
"""
