"""Mixture-controlled packing of token streams into fixed windows by deficit round-robin.

Documents are tokenised and dealt into lanes by hash, so every lane holds all sources. A lane keeps one queue for each
source and fills windows of `window` tokens: each window credits a source with its share, the source with the largest
credit is served next, at least `quantum` tokens at a time, and what a window could not give stays as credit for the next. The
credit that a lane begins with is what the lanes before it left: since a lane serves all it holds, this is a prefix sum over
the small relation (lane, source, tokens), and so are the numbers of its first sequence. Only a lane's last window is padded.

Cases: null texts are empty and take the end token alone; a null source is a queue of its own; repeated rows are packed
each; documents longer than a window are cut; an empty table gives no pieces; columns other than id, text and source
are not read. Token ids are those of the public byte-level vocabulary, special tokens' strings as ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm.common import MB, cut, packed, pieces, release, sliced, text_bytes
from matchwright.operators.numbering import running_sums

WINDOW, QUANTUM, END = 1024, 128, 0
#: Lead bytes of characters among which Unicode white space is found: no cut stands before them.
UNSURE = np.array([0xC2, 0xE1, 0xE2, 0xE3], np.uint8)
#: Bytes before which a blank begins a word of its own.
PLAIN = (np.arange(256) > 32) & (np.arange(256) != 127) & ~np.isin(np.arange(256), UNSURE)


class Encoder:
    """Ids of whole texts: each distinct word of a batch is encoded once, since no pre-token crosses a blank before a letter."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, first id of each text and the end)."""
        n_docs = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(n_docs + 1, np.int64)
        n = len(raw)
        begins = np.zeros(n + 1, bool)
        begins[: n - 1] = (raw[:-1] == 32) & PLAIN[raw[1:]]
        begins[offsets] = True
        bounds = np.flatnonzero(begins)
        units = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        coded = units.dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary
        at = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
        own, size = np.frombuffer(words.buffers()[2], np.uint8)[: at[-1]], np.diff(at)
        joinable = (size > 1) & (own[at[:-1]] == 32)
        joinable[joinable] = PLAIN[own[at[:-1][joinable] + 1]]
        sizes = size[joinable]
        text = own if joinable.all() else own[np.repeat(joinable, size)]
        ids = np.array(self.coder.encode_ordinary(text.tobytes().decode()), np.int32) if len(sizes) else np.zeros(0, np.int32)
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes), side="left") + 1
        counts, first = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        first[joinable] = np.append(0, ends[:-1]) if len(ends) else 0
        counts[joinable] = np.diff(np.append(0, ends))
        extra, upto = [ids], len(ids)
        for k in np.flatnonzero(~joinable):
            found = self.coder.encode_ordinary(words[k].as_py().decode())
            first[k], counts[k] = upto, len(found)
            upto += len(found)
            extra.append(np.array(found, np.int32))
        pool = np.concatenate(extra)
        n = counts[index]
        until = np.append(0, np.cumsum(n))
        flat = pool[np.repeat(first[index] - until[:-1], n) + np.arange(until[-1])]
        return flat, until[np.searchsorted(bounds, offsets)]


def tokenised(docs: DataFrame, id_col: str, text_col: str, source_col: str, vocabulary: str, pattern: str, end: int = END) -> DataFrame:
    """id, source, n, ids (unsigned 16-bit, the end id last), order (a hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in sliced(batches, "text", 2 * MB):
            coder = coder or Encoder(vocabulary, pattern)
            ids, first = coder.encode(*packed(batch.column("text")))
            ids, first = ids.astype(np.uint16), first.tolist()
            last = np.array([end], np.uint16).tobytes()
            blobs = [ids[a:b].tobytes() + last for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("source"), pa.array([len(x) // 2 for x in blobs], pa.int64()), pa.array(blobs, pa.binary()), batch.column("order")], names=["id", "source", "n", "ids", "order"]
            )
            del batch, ids, first, blobs
        del coder
        release()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"), F.xxhash64(F.lit(3), id_col, text_col, source_col).alias("order"))
    return rows.mapInArrow(run, f"id {kind}, source string, n long, ids binary, order long")


def fill(queues: list[list[tuple[int, int]]], shares: list[float], credit: list[float], window: int, quantum: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, window number, offset): queues hold (document, tokens) in order."""
    left = [sum(n for _, n in q) for q in queues]
    head, used = [0] * len(queues), [0] * len(queues)
    number, room, live = 0, window, [s for s in range(len(queues)) if left[s]]
    while live:
        total = sum(shares[s] for s in live) or 1.0
        for s in live:
            credit[s] += window * shares[s] / total
        heap = [(-credit[s], s) for s in live]
        heapq.heapify(heap)
        while room and heap:
            _, s = heapq.heappop(heap)
            give = min(room, left[s], max(quantum, int(credit[s])))
            credit[s] -= give
            left[s] -= give
            while give:
                doc, n = queues[s][head[s]]
                take = min(give, n - used[s])
                yield doc, used[s], take, number, window - room
                room -= take
                give -= take
                used[s] += take
                if used[s] == n:
                    head[s] += 1
                    used[s] = 0
            if left[s]:
                heapq.heappush(heap, (-credit[s], s))
        live = [s for s in live if left[s]]
        if not room:
            number, room = number + 1, window


def pack(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    window: int = WINDOW,
    quantum: int = QUANTUM,
    targets: dict[str, float] | None = None,
    lane_bytes: int = 4 * MB,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces: id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    Without `targets` each source's share is its share of all tokens.
    """
    _, size = text_bytes(docs, text_col)
    lanes = pieces(size, lane_bytes)
    tokens = cut(tokenised(docs, id_col, text_col, source_col, vocabulary, pattern).withColumn("lane", F.pmod("order", F.lit(lanes)).cast("int")))
    held = tokens.groupBy("lane", "source").agg(F.sum("n").alias("n"))
    by_lane = held.groupBy("lane").agg(F.sum("n").alias("lane_n"))
    by_lane = by_lane.withColumn("sequences", F.ceil(F.col("lane_n") / window))
    by_lane = running_sums(by_lane, "lane", {"before": "lane_n", "first_sequence": "sequences"}, lanes)
    by_source = held.groupBy("source").agg(F.sum("n").alias("source_n"))
    whole = by_source.agg(F.sum("source_n").alias("all_n"))
    if targets is None:
        share = by_source.crossJoin(F.broadcast(whole)).select("source", (F.col("source_n") / F.col("all_n")).alias("share"))
    else:
        given = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v)))])
        share = by_source.select("source", F.coalesce(given[F.coalesce("source", F.lit(""))], F.lit(0.0)).alias("share"))
    served = running_sums(held, "lane", {"served": "n"}, lanes, ("source",)).drop("n")
    plan = (
        served.join(by_lane, "lane").join(share.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .select(F.col("lane").alias("at_lane"), F.col("source").alias("of"), "share", (F.col("share") * F.col("before") - F.col("served")).alias("credit"), "first_sequence")
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        source, order, n = left.column("source").to_pylist(), left.column("order").to_numpy(), left.column("n").to_pylist()
        names = right.column("of").to_pylist()
        place = sorted(range(len(names)), key=lambda k: (names[k] is not None, names[k]))
        shares, credit = right.column("share").to_pylist(), right.column("credit").to_pylist()
        number = {names[k]: i for i, k in enumerate(place)}
        queues: list[list[tuple[int, int]]] = [[] for _ in place]
        for k in np.argsort(order, kind="stable").tolist():
            queues[number[source[k]]].append((k, n[k]))
        base = right.column("first_sequence")[0].as_py()
        blobs = left.column("ids")
        cols: list[list] = [[] for _ in range(6)]
        kept, crc, bits = [], [], []
        wide: dict[int, bytes] = {}
        for doc, start, length, seq, offset in fill(queues, [shares[k] for k in place], [credit[k] for k in place], window, quantum):
            ids = wide.get(doc)
            if ids is None:
                ids = wide[doc] = np.frombuffer(blobs[doc].as_py(), np.uint16).astype(np.uint32).tobytes()
            part = ids[4 * start : 4 * (start + length)]
            if start + length == n[doc]:
                del wide[doc]
            kept.append(doc)
            crc.append(zlib.crc32(part))
            if with_ids:
                bits.append(part)
            for c, v in zip(cols, (start, length, n[doc], base + seq, offset)):
                c.append(v)
        take = pa.array(kept, pa.int64())
        out = {
            "id": left.column("id").take(take),
            "source": left.column("source").take(take),
            "start": pa.array(cols[0], pa.int64()),
            "length": pa.array(cols[1], pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()),
            "doc_tokens": pa.array(cols[2], pa.int64()),
            "sequence_id": pa.array(cols[3], pa.int64()),
            "offset": pa.array(cols[4], pa.int64()),
        }
        made = pa.table(out | ({"ids": pa.array(bits, pa.binary())} if with_ids else {}))
        del left, right, queues, wide, blobs, kept, crc, bits, cols, take, out
        release()  # a worker that waits for its next lane holds little
        return made

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return tokens.groupBy("lane").cogroup(plan.groupBy("at_lane")).applyInArrow(run, schema).withColumnRenamed("id", id_col)


def public_vocabulary(path: str | None = None) -> tuple[str, str]:
    """(file, pattern) of the public byte-level vocabulary."""
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"), *public_vocabulary())
