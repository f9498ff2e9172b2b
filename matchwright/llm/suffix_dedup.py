"""Suffix-array de-duplication: removes every byte covered by a `length`-byte string that also starts earlier.

The plan moves positions, not text. (1) Two equal strings of `length` bytes choose the same k-gram inside them, the one
with the least hash, so only strings around a k-gram hash that occurs twice or more can repeat; each chosen k-gram
("anchor") stands for the strings that chose it, a short range of bytes. (2) Anchors are exchanged by hash in packed blobs.
Ranges with the same bytes are one class: its first occurrence represents it and the others are removed, within the map
task where possible, so a passage shared by a third of all documents sends one entry for each task. (3) The representatives
of anchors that stand in more than one class, whose strings may agree in part, are cut from the texts and sorted as
suffix-array shards by external induced sorting (induced_sort.py): suffixes whose carried common prefix reaches `length`
form a group, and all but its earliest member are removed. (4) Removed ranges meet their documents in the partitioning
of step 3, which the plan reuses.

Cases: a null text is empty; texts shorter than `length` lose nothing; an order among rows that share an id, or have none
(these stand last), is given by their place in the scan, so of repeated rows one keeps its text; matches never cross
documents. Empty tables give empty results, and other columns ride along only where asked for. Bytes FE and FF, which
UTF-8 does not use, must not occur in a text. Ids must be integers.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm.common import BASE_B, MB, Rolling, packed, pieces, release, sliced, text_bytes
from matchwright.llm.induced_sort import sorted_suffixes

LENGTH, GRAM = 100, 32
#: Anchors that a map task holds before it sends them.
FLUSH = 200_000
LAST = np.iinfo(np.int64).max
ROW = "_row"


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM, block: int = MB // 8) -> dict[str, np.ndarray]:
    """The anchors of a batch of texts: document index, position, hash, and the strings (first..last start) that chose it.

    Strings are taken in blocks of their starts, so a text of any length needs the memory of a block.
    """
    found = []
    for begin in range(0, max(1, len(raw) - length + 1), block):
        stop = min(len(raw), begin + block + length - 1)
        low, high = int(np.searchsorted(offsets, begin, side="right")) - 1, int(np.searchsorted(offsets, stop))
        part = _anchors(raw[begin:stop], np.clip(offsets[low : high + 1] - begin, 0, stop - begin), length, gram)
        back = begin - offsets[low : high + 1]
        part["doc"] = part["doc"] + low
        shift = np.maximum(back, 0)[part["doc"] - low]
        for k in ("at", "first", "last"):
            part[k] = part[k] + shift
        found.append(part)
    return {k: np.concatenate([p[k] for p in found]) for k in found[0]}


def _anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    none = {k: np.zeros(0, np.int64) for k in ("doc", "at", "first", "last")} | {"hash": np.zeros(0, np.uint64), "same": np.zeros(0, np.uint64)}
    n = len(raw)
    if n < length:
        return none
    roll = Rolling(raw)
    w = length - gram + 1
    starts = np.arange(n - gram + 1)
    h = roll.of(starts, starts + gram)
    # least hash, and its leftmost place, in each window of w k-grams: doubling, then two overlapping windows
    place = np.arange(len(h), dtype=np.int32)
    span = 1
    while span * 2 <= w:
        a, b = place[:-span], place[span:]
        place = np.where(h[b] < h[a], b, a)
        span *= 2
    m = n - length + 1
    a, b = place[:m], place[w - span : w - span + m]
    chosen = np.where(h[b] < h[a], b, a)
    doc = np.searchsorted(offsets, np.arange(m), side="right") - 1
    inside = np.arange(m) + length <= offsets[doc + 1]
    p = np.flatnonzero(inside)
    if not len(p):
        return none
    c, d = chosen[p].astype(np.int64), doc[p]
    new = np.ones(len(p), bool)
    new[1:] = (c[1:] != c[:-1]) | (p[1:] != p[:-1] + 1) | (d[1:] != d[:-1])
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(p)) - 1
    first, last, at = p[s], p[e], c[s]
    other = Rolling(raw, BASE_B)
    same = other.of(first, last + length) + (at - first).astype(np.uint64)
    base = offsets[d[s]]
    return {"doc": d[s], "at": at - base, "first": first - base, "last": last - base, "hash": h[at], "same": same}


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the ranges of each document."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    step = int(stop.max()) + 1
    rank = np.cumsum(np.append(0, doc[1:] != doc[:-1]))
    reach = np.maximum.accumulate(stop + rank * step)
    new = np.ones(len(doc), bool)
    new[1:] = (start + rank * step)[1:] > reach[:-1]
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(doc)) - 1
    return doc[s], start[s], reach[e] - rank[e] * step


RANGE = "kind int, row long, id long, start long, stop long, at long, hash long"


def _ranges(kind: int, row, ident, start, stop, at, h) -> pa.Table:
    n = len(row)
    return pa.table(
        {
            "kind": pa.array(np.full(n, kind, np.int32)),
            "row": pa.array(np.asarray(row, np.int64)),
            "id": pa.array(np.asarray(ident, np.int64)),
            "start": pa.array(np.asarray(start, np.int64)),
            "stop": pa.array(np.asarray(stop, np.int64)),
            "at": pa.array(np.asarray(at, np.int64)),
            "hash": pa.array(np.asarray(h).astype(np.uint64).view(np.int64)),
        }
    )


BLOB = "bucket int, rows binary, ids binary, doc binary, at binary, first binary, last binary, hash binary, same binary"
KINDS = {"rows": np.int64, "ids": np.int64, "doc": np.uint32, "at": np.uint32, "first": np.uint32, "last": np.uint32, "hash": np.uint64, "same": np.uint64}


def _sent(buckets: int, length: int, gram: int, flush: int):
    """Map side of the exchange: anchors by bucket, and at bucket -1 the ranges that an earlier row of the task repeats."""

    def emit(held: list[dict[str, np.ndarray]], rows: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        x = {k: np.concatenate([y[k] for y in held]) for k in held[0]}
        order = np.lexsort((x["at"], rows[x["doc"]], ids[x["doc"]], x["same"], x["hash"]))
        x = {k: v[order] for k, v in x.items()}
        new = np.ones(len(order), bool)
        new[1:] = (x["hash"][1:] != x["hash"][:-1]) | (x["same"][1:] != x["same"][:-1])
        out = {name: [] for name in ("bucket", *KINDS)}

        def put(bucket: int, sel: dict[str, np.ndarray]) -> None:
            docs, index = np.unique(sel["doc"], return_inverse=True)
            values = {"rows": rows[docs], "ids": ids[docs], "doc": index} | {k: sel[k] for k in ("at", "first", "last", "hash", "same")}
            out["bucket"].append(bucket)
            for k, kind in KINDS.items():
                out[k].append(values[k].astype(kind).tobytes())

        gone = {k: v[~new] for k, v in x.items()}
        if len(gone["doc"]):
            d, a, b = merged(gone["doc"], gone["first"], gone["last"] + length)
            put(-1 - int(d[0]) % buckets, {"doc": d, "at": a, "first": np.zeros(len(d)), "last": np.zeros(len(d)), "hash": b.astype(np.uint64), "same": np.zeros(len(d))})
        x = {k: v[new] for k, v in x.items()}
        x["first"], x["last"] = x["at"] - x["first"], x["at"] - x["last"]
        bucket = (x["hash"] >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        there, edge = np.unique(bucket[order], return_index=True)
        for b, pick in zip(there.tolist(), np.split(order, edge[1:])):
            put(b, {k: v[pick] for k, v in x.items()})
        yield pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), *[pa.array(out[k], pa.binary()) for k in KINDS]], names=["bucket", *KINDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, ids, count, docs = [], [], [], 0, 0
        for batch in sliced(batches, "text", MB):
            found = anchors(*packed(batch.column("text")), length, gram)
            found["doc"] = found["doc"] + docs
            held.append(found)
            rows.append(batch.column(ROW).to_numpy())
            ids.append(pc.fill_null(batch.column("id"), LAST).to_numpy(zero_copy_only=False))
            docs += batch.num_rows
            count += len(found["doc"])
            if count > flush:
                yield from emit(held, np.concatenate(rows), np.concatenate(ids))
                held, rows, ids, count, docs = [], [], [], 0, 0
        if count:
            yield from emit(held, np.concatenate(rows), np.concatenate(ids))
        del held
        release()

    return run


def _met(length: int):
    """Reduce side: ranges that repeat an earlier one (kind 1), and the representatives to be sorted (kind 2)."""

    def run(t: pa.Table) -> pa.Table:
        cols = {k: [np.frombuffer(x, dtype=kind) for x in t.column(k).to_pylist()] for k, kind in KINDS.items()}
        row = np.concatenate([r[d] for r, d in zip(cols["rows"], cols["doc"])])
        ident = np.concatenate([r[d] for r, d in zip(cols["ids"], cols["doc"])])
        at, first, last = (np.concatenate(cols[k]).astype(np.int64) for k in ("at", "first", "last"))
        h, same = np.concatenate(cols["hash"]), np.concatenate(cols["same"])
        del cols
        if t.column("bucket")[0].as_py() < 0:
            return _ranges(1, row, ident, at, h.astype(np.int64), at, np.zeros(len(row)))
        order = np.argsort(h, kind="stable")
        hs = h[order]
        edge = np.flatnonzero(np.append(True, hs[1:] != hs[:-1]))
        many = np.repeat(np.diff(np.append(edge, len(hs))), np.diff(np.append(edge, len(hs)))) > 1
        keep = order[many]
        row, ident, at, first, last, h, same = (x[keep] for x in (row, ident, at, first, last, h, same))
        order = np.lexsort((at, row, ident, same, h))
        row, ident, at, first, last, h, same = (x[order] for x in (row, ident, at, first, last, h, same))
        if not len(h):
            return _ranges(1, row, ident, at, at, at, h)
        group = np.append(True, h[1:] != h[:-1])
        new = group | np.append(True, same[1:] != same[:-1])
        classes = np.add.reduceat(new.astype(np.int64), np.flatnonzero(group))
        several = np.repeat(classes, np.diff(np.append(np.flatnonzero(group), len(h)))) > 1
        start, stop = at - first, at - last + length
        gone, ask = ~new, new & several
        return pa.concat_tables([_ranges(1, row[gone], ident[gone], start[gone], stop[gone], at[gone], h[gone]), _ranges(2, row[ask], ident[ask], start[ask], stop[ask], at[ask], h[ask])])

    return run


def _cut(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the ranges asked for, by shard."""
    for batch in sliced(batches, "text", 2 * MB):
        raw, offsets = packed(batch.column("text"))
        whole = raw.tobytes()
        asked = batch.column("asked")
        counts = pc.list_value_length(asked).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = asked.flatten()
        start, stop, h = (flat.field(k).to_numpy() for k in ("start", "stop", "hash"))
        base = np.repeat(offsets[:-1], counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(((h.view(np.uint64) >> np.uint64(16)) % np.uint64(shards)).astype(np.int32)),
                pa.array(np.repeat(batch.column("row").to_numpy(), counts)),
                pa.array(np.repeat(pc.fill_null(batch.column("id"), LAST).to_numpy(zero_copy_only=False), counts)),
                pa.array(start),
                pa.array([whole[a:b] for a, b in zip((base + start).tolist(), (base + stop).tolist())], pa.binary()),
            ],
            names=["shard", "row", "id", "start", "bytes"],
        )
    release()


def _sorted_shard(length: int, limit: int, base: int):
    """One suffix-array shard: the ranges whose strings start earlier elsewhere in the shard."""

    def run(t: pa.Table) -> pa.Table:
        chunks = t.column("bytes").to_pylist()
        row, ident, start = (t.column(k).to_numpy() for k in ("row", "id", "start"))
        sizes = np.array([len(c) for c in chunks], np.int64)
        # two is added to each byte; 1 ends a range and 0 the text
        text = (np.frombuffer(b"\xff".join(chunks) + b"\xff", dtype=np.uint8) + np.uint8(2)).astype(np.uint8)
        begin = np.append(0, np.cumsum(sizes + 1))[:-1]
        text = np.append(text, np.uint8(0))
        text[begin + sizes] = 1
        with tempfile.TemporaryDirectory() as folder:
            order, lcp = sorted_suffixes(text, length, folder, limit, base)
        which = np.searchsorted(begin, order, side="right") - 1
        offset = order - begin[which]
        full = offset + length <= sizes[which]
        link = (lcp >= length) & full
        link[1:] &= full[:-1]
        group = np.cumsum(~link)
        pick = np.flatnonzero(full)
        g, w, o = group[pick], which[pick], offset[pick]
        by = np.lexsort((start[w] + o, row[w], ident[w], g))
        g, w, o = g[by], w[by], o[by]
        later = np.flatnonzero(np.append(False, g[1:] == g[:-1]))
        w, o = w[later], o[later]
        w, a, b = merged(w, o, o + length)
        del text, order, lcp, which, offset, full, link, group
        release()
        return _ranges(1, row[w], ident[w], start[w] + a, start[w] + b, start[w] + a, np.zeros(len(w)))

    return run


def _removed(batches: Iterator[pa.RecordBatch], keep: list[str], decoded: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", 2 * MB):
        raw, offsets = packed(batch.column("text"))
        whole = raw.tobytes()
        n, out = batch.num_rows, {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "starts", "stops")}
        gone = batch.column("gone")
        counts = pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = gone.flatten()
        doc, a, b = merged(np.repeat(np.arange(n), counts), flat.field("start").to_numpy(), flat.field("stop").to_numpy())
        bounds = np.searchsorted(doc, np.arange(n + 1)).tolist()
        a, b, offsets = a.tolist(), b.tolist(), offsets.tolist()
        for i in range(n):
            text = whole[offsets[i] : offsets[i + 1]]
            starts, stops = a[bounds[i] : bounds[i + 1]], b[bounds[i] : bounds[i + 1]]
            kept = b"".join(text[x:y] for x, y in zip([0, *stops], [*starts, len(text)])) if starts else text
            for k, v in zip(out, (len(text), len(text) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept, starts, stops)):
                out[k].append(v)
        if decoded:
            null = batch.column("text").is_null().to_pylist()
            out["kept"] = [None if x else k.decode(errors="ignore").encode() for k, x in zip(out["kept"], null)]
        made = {
            "n_bytes": pa.array(out["n_bytes"], pa.int64()),
            "n_removed": pa.array(out["n_removed"], pa.int64()),
            "n_spans": pa.array(out["n_spans"], pa.int64()),
            "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
            "kept": pa.array(out["kept"], pa.binary()),
            "starts": pa.array(out["starts"], pa.list_(pa.int64())),
            "stops": pa.array(out["stops"], pa.list_(pa.int64())),
        }
        yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep if k not in made], *[made[k] for k in made if k in keep]], names=[*[k for k in keep if k not in made], *[k for k in made if k in keep]])
        del batch, raw, whole, out, made
    release()


MADE = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string", "kept": "binary", "starts": "array<long>", "stops": "array<long>"}


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    made: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept_sha256"),
    carry: tuple[str, ...] = (),
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = 2 * MB,
    queue_limit: int = 4_000_000,
    base: int = 4_000_000,
    decoded: bool = False,
) -> DataFrame:
    """id, the columns of `carry`, and those of `made` (see MADE: the kept bytes and the removed spans among them).

    With `decoded`, the kept bytes come back as the text column: what a removed range left of a character is dropped, and a
    null text stays null.
    """
    _, size = text_bytes(docs, text_col)
    shards = pieces(size, shard_bytes, 16)
    buckets = pieces(size, 8 * MB, 16)
    named = docs.select(
        F.monotonically_increasing_id().alias(ROW), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        *[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)],
    )
    sent = named.select(ROW, "id", "text").mapInArrow(_sent(buckets, length, gram, FLUSH), BLOB)
    met = sent.groupBy("bucket").applyInArrow(_met(length), RANGE)
    placed = named.repartition(pieces(size, 16 * MB, 12), ROW)
    asked = met.where("kind = 2").groupBy(F.col("row")).agg(F.collect_list(F.struct("start", "stop", "hash")).alias("asked"))
    texts = placed.join(asked, F.col(ROW) == F.col("row")).select("row", "id", "text", "asked")
    cut = texts.mapInArrow(lambda it: _cut(it, shards), "shard int, row long, id long, start long, bytes binary")
    again = cut.groupBy("shard").applyInArrow(_sorted_shard(length, queue_limit, base), RANGE)
    gone = (
        met.where("kind = 1").select("row", "start", "stop").unionByName(again.select("row", "start", "stop"))
        .groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    )
    both = placed.join(gone, F.col(ROW) == F.col("row"), "left").drop("row", ROW)
    keep = ["id", *[f"_c{k}" for k in range(len(carry))], *made]
    kinds = {f.name: f.dataType.simpleString() for f in both.schema} | MADE
    out = both.mapInArrow(lambda it: _removed(it, keep, decoded), ", ".join(f"`{k}` {kinds[k]}" for k in [*[k for k in keep if k not in MADE], *[k for k in MADE if k in keep]]))
    ident, rest = F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), [F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)]
    if decoded:
        return out.select(ident, *rest, F.col("kept").cast("string").alias(text_col), *[m for m in made if m != "kept"])
    return out.select(ident, *rest, *made)


#: The same rows from every 100-byte string, in hexadecimal digits: for small tables.
OP7_SQL = r"""
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
    SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 200) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d)
), first AS (
    SELECT w, min((doc_id, i)) AS f FROM s GROUP BY w HAVING count(*) > 1
), later AS (
    SELECT s.doc_id, s.i FROM s JOIN first USING (w) WHERE (s.doc_id, s.i) <> f
), run AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM later
), span AS (
    SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM run) GROUP BY doc_id, k
), gap AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span
), cut AS (
    SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, list((before, a) ORDER BY a) AS pieces FROM gap GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE concat(list_reduce(list_prepend('', list_transform(pieces, lambda p: substr(h, CAST(2 * p[1] + 1 AS BIGINT), CAST(2 * (p[2] - p[1]) AS BIGINT)))), lambda x, y: concat(x, y)), substr(h, CAST(2 * last + 1 AS BIGINT))) END)) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
"""


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
