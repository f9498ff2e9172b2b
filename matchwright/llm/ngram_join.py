"""N-gram Jaccard self-join by adaptive multi-match prefixes, and the classes that its links form.

A document's set holds its distinct five-word shingles. All sets are put in one global order: shingles that a first pass
found frequent come last, by frequency, the others by hash. A document's prefix is its first `p = n - ceil(t n) + l`
shingles; each document lengthens its prefix by the l of least estimated cost (entries of the lists it would meet, and
candidates among them). Of two sets, the one whose prefix ends first has all its other shared shingles among its last
n - p, so a pair must share `needed overlap - max(n - p)` prefix shingles: the longer the prefixes, the more. The same
set overlaps by its reach at most: what is left of it without the prefix shingles that stand in no other prefix.

Prefix shingles meet in packed blobs. Sets that are equal within a map task join their first one at once. In a list of
at most `short` documents all pairs are counted. In a longer list each document is paired with the list's pivot, the one of
largest reach; lists with the same pivot are one family. Each document is then verified with the one it shares most with, and of
all other pairs, those of the families included, only those matter that stand in different components and whose overlap the
reach and the parity bits of the whole sets allow: a group of thousands of near copies costs a star, yet no link between
different components is lost. Pairs are verified on whole sets.

Cases: null texts and texts without words have an empty set and link with nothing; a text of fewer than five words is
one shingle. Rows that share an id, or have none, are told apart by their place in the scan; a component is named by its
least id. Empty tables give empty results; other columns are not read. `docs` must be a table scan or otherwise stable.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm.common import BASE_B, MB, cut, drop, free, lowered, mix, packed, pieces, release, sliced, text_bytes, tidy, word_hashes, words_of
from matchwright.llm.components import components

WORDS, PERCENT = 5, 75
STEPS = (1, 2, 4, 8, 16)  # by how much a prefix may be lengthened
FREQUENT, SEEN = 200_000, 2
BROADCAST_ROWS = 2_000_000  # 16 MB of row numbers
FEW = 8  # documents to a pair whose texts meet without more ado
BITMAPS = 16_384  # of 4 KB, for 32,768 row numbers each
PARITY = 4  # 64-bit words of a set's parity bits
LEAVES = 512  # documents that a hub's text is sent to at once
ROW = "_row"


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, by document and hash."""
    start, stop, doc = words_of(raw, offsets)
    n_docs = len(offsets) - 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = word_hashes(lowered(raw), start, stop)
    n = len(word)
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
    count = np.bincount(doc, minlength=n_docs)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total[: max(0, n - k)] += word[k:] * odd[k % 5]
    whole = np.zeros(n, bool)
    if n >= size:
        whole[: n - size + 1] = doc[: n - size + 1] == doc[size - 1 :]
    at = np.flatnonzero(whole)
    d, h = doc[at], mix(total[at])
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        first = np.searchsorted(doc, few)
        h2 = np.zeros(len(few), np.uint64)
        for k in range(size - 1):
            has = count[few] > k
            h2[has] += word[first[has] + k] * odd[k]
        d, h = np.append(d, few), np.append(h, mix(h2 + count[few].astype(np.uint64)))
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


def _seen(held: list[np.ndarray]) -> pa.RecordBatch:
    h = np.sort(np.concatenate(held))
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(h)))
    h, n = h[first[n >= SEEN]], n[n >= SEEN]
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])


def frequent(docs: DataFrame, text_col: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and estimates of their document counts, FREQUENT at most.

    They only choose the order and the l of each document, so any bound keeps the result whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in sliced(batches, text_col, MB):
            held.append(shingles(*packed(batch.column(text_col)), size)[1])
            count += len(held[-1])
            if count > 2_000_000:
                yield _seen(held)
                held, count = [], 0
        if held:
            yield _seen(held)
        del held
        release()

    top = docs.select(text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = top.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    h = rows.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], rows.column("n").to_numpy()[order]


def least_overlap(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return -(-percent * n // 100)


def needed(na: np.ndarray, pa_: np.ndarray, nb: np.ndarray, pb: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many prefix shingles a linked pair shares at least; more than min(n) if the sizes cannot link."""
    overlap = -(-percent * (na + nb) // (100 + percent))
    return np.where(overlap > np.minimum(na, nb), np.iinfo(np.int32).max, np.maximum(1, overlap - np.maximum(na - pa_, nb - pb)))


def choose(doc: np.ndarray, pos: np.ndarray, df: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """For each document the l of least estimated cost: an entry for each prefix shingle, and the candidates that the lists
    bring, twice as dear and fewer by l as each must be met l times. A shingle not known as frequent has one document."""
    need = least_overlap(n, percent)
    best, cost = np.ones(len(n), np.int64), np.full(len(n), np.inf)
    others = np.maximum(df, 1) - 1
    for l in STEPS:
        met = np.bincount(doc, weights=np.where(pos < (n - need + l)[doc], others, 0), minlength=len(n))
        now = (n - need + l) + met * 2 / l
        better = (now < cost) & (l <= need)
        best[better], cost[better] = l, now[better]
    return best


def parities(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """PARITY words for each document: a bit for each of 64 PARITY classes of shingles, set where it holds an odd number of them."""
    bit = (mix(h ^ np.uint64(BASE_B)) % np.uint64(64 * PARITY)).astype(np.int64)
    odd = np.bincount(doc * (64 * PARITY) + bit, minlength=n_docs * 64 * PARITY) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64).reshape(n_docs, PARITY)


ENTRY = "bucket int, base long, rows binary, hash binary, ids binary, n binary, p binary, end binary, bits binary"
KINDS = {"rows": np.uint32, "hash": np.uint64, "ids": np.int64, "n": np.uint32, "p": np.uint32, "end": np.int64, "bits": np.uint64}


def _sent(known: tuple[np.ndarray, np.ndarray], buckets: int, size: int, percent: int, flush: int):
    """Prefix entries by bucket, as rows (above `base`) and hashes. Bucket -1 - b: all documents, and in `hash` the row of the first with the same set."""
    hot, hot_n = known

    def emit(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        shift, parts = 0, [[] for _ in range(7)]
        for rows, ids, n, doc, h, sig, bits in held:
            for p, x in zip(parts, (rows, ids, n, doc + shift, h, sig, bits)):
                p.append(x)
            shift += len(rows)
        rows, ids, n, doc, h, sig, bits = (np.concatenate(p) for p in parts)
        # equal sets within the task: the least (id, row) stands for them
        order = np.lexsort((rows, ids, n, sig[:, 1], sig[:, 0]))
        s = sig[order]
        new = np.ones(len(order), bool)
        new[1:] = (s[1:] != s[:-1]).any(axis=1) | (n[order][1:] != n[order][:-1])
        new |= n[order] == 0
        first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        stands = np.empty(len(order), np.int64)
        stands[order] = first
        out = {k: [] for k in ("bucket", "base", *KINDS)}
        base = int(rows.min())
        above = rows - base  # rows of a task follow each other

        def put(bucket: int, **x) -> None:
            out["bucket"].append(bucket)
            out["base"].append(base)
            for k, kind in KINDS.items():
                out[k].append(np.asarray(x.get(k, [])).astype(kind).tobytes())

        alone = stands == np.arange(len(stands))
        keep = alone[doc]
        doc, h = doc[keep], h[keep]
        df = np.zeros(len(h), np.int64)
        if len(hot) and len(h):
            at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
            df = np.where(hot[at] == h, np.minimum(hot_n[at], (1 << 31) - 1), 0)
        order = np.lexsort((h, df, doc))
        doc, h, df = doc[order], h[order], df[order]
        begin = np.searchsorted(doc, np.arange(len(rows)))
        pos = np.arange(len(doc)) - begin[doc]
        prefix = np.minimum(n, n - least_overlap(n, percent) + choose(doc, pos, df, n, percent))
        end = np.zeros(len(rows), np.int64)  # where each prefix ends in the global order
        last = np.flatnonzero(pos == prefix[doc] - 1)
        end[doc[last]] = (df[last] << 32) | (h[last] >> np.uint64(32)).astype(np.int64)
        put(-1 - base % buckets, rows=above, ids=ids, n=n, p=prefix, end=end, hash=rows[stands], bits=bits.ravel())
        pick = pos < prefix[doc]
        doc, h = doc[pick], h[pick]
        bucket = (h >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        there, edge = np.unique(bucket[order], return_index=True)
        for b, p in zip(there.tolist(), np.split(order, edge[1:])):
            put(b, rows=above[doc[p]], hash=h[p])
        columns = [pa.array(out["bucket"], pa.int32()), pa.array(out["base"], pa.int64()), *[pa.array(out[k], pa.binary()) for k in KINDS]]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "base", *KINDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in sliced(batches, "text", MB):
            doc, h = shingles(*packed(batch.column("text")), size)
            n = np.bincount(doc, minlength=batch.num_rows).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(h)]).astype(np.uint64)
            other = np.concatenate([[0], np.cumsum(mix(h))]).astype(np.uint64)
            begin = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            sig = np.stack([sums[begin[1:]] - sums[begin[:-1]], other[begin[1:]] - other[begin[:-1]]], axis=1)
            ids = pc.fill_null(batch.column("id"), np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            held.append((batch.column(ROW).to_numpy(), ids, n, doc, h, sig, parities(doc, h, batch.num_rows)))
            count += len(h)
            if count > flush:
                yield from emit(held)
                held, count = [], 0
        if held:
            yield from emit(held)
        del held
        release()

    return run


MET = "kind int, a long, b long, n int, p int, hash long, end long, bits array<long>"


def _rows(kind: int, a, b=None, n=None, p=None, h=None, end=None, bits=None) -> pa.Table:
    none = lambda x, t: pa.nulls(len(a), t) if x is None else pa.array(np.asarray(x).astype(t.to_pandas_dtype(), copy=False), t)
    return pa.table(
        {
            "kind": pa.array(np.full(len(a), kind, np.int32)),
            "a": none(a, pa.int64()),
            "b": none(b, pa.int64()),
            "n": none(n, pa.int32()),
            "p": none(p, pa.int32()),
            "hash": none(None if h is None else h.view(np.int64), pa.int64()),
            "end": none(end, pa.int64()),
            "bits": pa.nulls(len(a), pa.list_(pa.int64())) if bits is None else pa.ListArray.from_arrays(np.arange(len(a) + 1, dtype=np.int32) * PARITY, pa.array(bits.view(np.int64))),
        }
    )


def _counted(a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Pairs of rows with how often each occurs."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))) if len(low) else np.zeros(0, np.int64)
    return _rows(1, low[new], high[new], np.diff(np.append(new, len(low))))


def _met(short: int):
    """Kind 0: a document: row, id, n, p, end, parity, and in `hash` the row it equals. 1: a pair and the n short lists that it
    shares. 2: how many (n) of a document's prefix shingles others have too. 3: an entry of a long list."""

    def run(t: pa.Table) -> pa.Table:
        base = t.column("base").to_numpy()
        cols = {k: [np.frombuffer(x, dtype=kind) for x in t.column(k).to_pylist()] for k, kind in KINDS.items()}
        row = np.concatenate([x.astype(np.int64) + b for x, b in zip(cols["rows"], base)])
        if t.column("bucket")[0].as_py() < 0:
            ids, n, p, end, h, bits = (np.concatenate(cols[k]) for k in ("ids", "n", "p", "end", "hash", "bits"))
            return _rows(0, row, ids, n, p, h, end, bits)
        h = np.concatenate(cols["hash"])
        del cols
        order = np.lexsort((row, h))
        row, h = row[order], h[order]
        edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        sizes = np.diff(np.append(edge, len(h)))
        keep = np.repeat(sizes, sizes) > 1
        row, h = row[keep], h[keep]
        if not len(h):
            return _rows(1, row)
        sizes = sizes[sizes > 1]
        edge = np.cumsum(sizes) - sizes
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for gap in range(1, short):  # pairs `gap` apart in their list
            with_gap = np.flatnonzero((sizes > gap) & (sizes <= short))
            if not len(with_gap):
                break
            m = sizes[with_gap] - gap
            a = np.repeat(edge[with_gap], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            first.append(a)
            second.append(a + gap)
        rows, shared = np.unique(row, return_counts=True)
        release()
        at = np.flatnonzero(np.repeat(sizes > short, sizes))
        return pa.concat_tables([_counted(row[np.concatenate(first)], row[np.concatenate(second)]), _rows(2, rows, n=shared), _rows(3, row[at], h=h[at])])

    return run


def _linked(size: int, percent: int):
    """(u, v) that link: rows come by (hub, salt), the hub's own text first (leaf -1), then those of the leaves it is tried with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in sliced(batches, "text", MB):
            d, h = shingles(*packed(batch.column("text")), size)
            hub, salt, leaf = (batch.column(c).to_numpy() for c in ("hub", "salt", "leaf"))
            at = np.searchsorted(d, np.arange(batch.num_rows + 1))
            first = np.flatnonzero(np.append(True, (hub[1:] != hub[:-1]) | (salt[1:] != salt[:-1])))
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for i, j in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows]):
                if leaf[i] < 0:
                    mine, i = h[at[i] : at[i + 1]], i + 1
                if i == j or not len(mine):
                    continue
                own = h[at[i] : at[j]]
                shared = mine[np.minimum(np.searchsorted(mine, own), len(mine) - 1)] == own
                common = np.bincount(d[at[i] : at[j]] - i, weights=shared, minlength=j - i).astype(np.int64)
                both = len(mine) + np.diff(at[i : j + 1]) - common
                keep = (100 * common >= percent * both) & (common > 0)
                found.append((hub[i:j][keep], leaf[i:j][keep]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["u", "v"])
            del batch, d, h
        release()

    return run


def _sketch(size: int):
    """Row, set size and parity bits of a text's set: a power of two of them, one or more for each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", MB):
            d, h = shingles(*packed(batch.column("text")), size)
            n = np.bincount(d, minlength=batch.num_rows).astype(np.int64)
            m = 1 << np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64)
            end = np.cumsum(m)
            bit = (mix(h ^ np.uint64(BASE_B)) & (m[d] - 1).astype(np.uint64)).astype(np.int64)
            odd = np.bincount((end - m)[d] + bit, minlength=int(end[-1])) & 1
            raw = np.packbits(odd.astype(bool), bitorder="little").tobytes()
            bits = [raw[(e - k) // 8 : e // 8] for e, k in zip(end.tolist(), m.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(n), pa.array(bits, pa.binary())], names=[ROW, "n", "bits"])
        release()

    return run


def _folded(bits: list[bytes], m: int) -> np.ndarray:
    """Sketches of one length as rows of m bytes: the parities of fewer bits."""
    return np.bitwise_xor.reduce(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1, m), axis=1)


def _passed(percent: int):
    """The pairs (a, b) that can link by their sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
                x, y = (batch.column(c).to_pylist() for c in ("xa", "xb"))
                differ = np.zeros(len(na), np.int64)
                lengths = np.array([(len(u), len(v)) for u, v in zip(x, y)])
                for u, v in np.unique(lengths, axis=0).tolist():
                    own = np.flatnonzero((lengths == (u, v)).all(axis=1))
                    p, q = (_folded([z[i] for i in own.tolist()], min(u, v)) for z in (x, y))
                    differ[own] = np.bitwise_count(p ^ q).sum(axis=1)
                overlap = -(-percent * (na + nb) // (100 + percent))
                keep = pa.array(2 * overlap <= na + nb - differ)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in "ab"], names=["a", "b"])
            release()

    return run


def _thinned(pairs: DataFrame, named: DataFrame, every: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that can link. Where they are many for the documents, sketches meet before texts do.

    The pairs of a family that 64 PARITY bits do not tell apart grow with the square of its size, and their texts with them.
    """
    pairs = cut(pairs)
    if pairs.count() * FEW <= every.count():
        return pairs
    ends = pairs.select(F.col("a").alias(ROW)).unionByName(pairs.select(F.col("b").alias(ROW)))
    sketches = cut(_wanted(named.select(ROW, "text"), ends).mapInArrow(_sketch(size), f"{ROW} long, n long, bits binary"))
    of = lambda k: sketches.select(F.col(ROW).alias(k), F.col("n").alias("n" + k), F.col("bits").alias("x" + k))
    kept = cut(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(_passed(percent), "a long, b long"))
    drop(sketches)
    drop(pairs)
    return kept


def _wanted(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of these rows: bits of their numbers go along with the tasks, so that no other text moves."""
    number, bit = F.bitmap_bucket_number(F.col(ROW)), F.bitmap_bit_position(F.col(ROW))
    bits = cut(rows.select(number.alias("of"), bit.alias("bit")).groupBy("of").agg(F.bitmap_construct_agg("bit").alias("bits")))
    if bits.count() > BITMAPS:
        return texts
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    there = byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))")) != 0
    return texts.withColumns({"_of": number, "_bit": bit}).join(F.broadcast(bits), F.col("_of") == F.col("of")).where(there).select(*texts.columns)


def _links(pairs: DataFrame, named: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Of each pair the row that stands in more of them is the hub.

    A hub's text goes once to each LEAVES of its leaves, which meet it in the order of a sort: a pivot of thousands of documents is not
    copied to each. Texts are moved, not sets: they are half as large and packed by the exchange.
    """
    pairs = cut(pairs)
    ends = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row")))
    degree = cut(ends.groupBy("row").agg(F.count(F.lit(1)).alias("d")))
    of = lambda k: degree.select(F.col("row").alias(k), F.col("d").alias("d" + k))
    more = F.expr("da >= db")
    way = pairs.join(of("a"), "a").join(of("b"), "b").select(
        F.when(more, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(more, F.col("b")).otherwise(F.col("a")).alias("leaf"), F.ceil(F.greatest("da", "db") / LEAVES).alias("salts")
    )
    way = cut(way.select("hub", "leaf", F.pmod(F.xxhash64("leaf"), F.col("salts")).alias("salt")))
    drop(degree)
    drop(pairs)
    texts, sent = named.select(ROW, "text"), way.select("hub", "salt").distinct()
    if way.count() <= BROADCAST_ROWS // 3:
        leaves = texts.join(F.broadcast(way), F.col("leaf") == F.col(ROW)).select("hub", "salt", "leaf", "text")
        hubs = texts.join(F.broadcast(sent), F.col("hub") == F.col(ROW)).select("hub", "salt", F.lit(-1).cast("long").alias("leaf"), "text")
        rows = leaves.unionByName(hubs)
    else:  # the texts that are wanted meet rows in a shuffle, once for both ends
        ways = way.select(F.col("leaf").alias(ROW), "hub", "salt", "leaf").unionByName(sent.select(F.col("hub").alias(ROW), "hub", "salt", F.lit(-1).cast("long").alias("leaf")))
        rows = _wanted(texts, ways.select(ROW)).join(ways, ROW).select("hub", "salt", "leaf", "text")
    found = cut(rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "leaf").mapInArrow(_linked(size, percent), "u long, v long"))
    drop(way)
    return found


def _overlap(x: str, y: str, percent: int):
    """The least overlap of two linked sets of x and y shingles."""
    return F.expr(f"cast((({percent} * ({x} + {y})) + {99 + percent}) div {100 + percent} as int)")


def _alike(percent: int):
    """Whether the sets of sides a and b (na, w0a, ...; nb, w0b, ...) can link by their parity bits.

    Sets of which `d` bits differ have a symmetric difference of `d` at least, so they share (na + nb - d) / 2 at most.
    """
    differ = " + ".join(f"bit_count(w{i}a ^ w{i}b)" for i in range(PARITY))
    return F.expr(f"2 * cast((({percent} * (na + nb)) + {99 + percent}) div {100 + percent} as int) <= na + nb - ({differ})")


def _words(k: str) -> list:
    return [F.col("bits")[i].alias(f"w{i}{k}") for i in range(PARITY)]


def _families(met: DataFrame, every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, to) for each document of a long list and the pivot of that list, once however many lists they share (`n` counts them).

    The pivot has the largest share of its shingles within reach, so lists of one group of near copies mostly name the same one.
    Documents of one list are in one family, so nothing is lost by looking for pairs in families. Second: (row, lists, other), the
    long lists of each document and how many of its prefix shingles stand in short ones.
    """
    reach = met.where("kind = 2").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("common"))
    entries = met.where("kind = 3").select(F.col("a").alias("row"), "hash").join(reach, "row")
    entries = entries.join(every.select(F.col(ROW).alias("row"), F.col("n").alias("na"), F.col("p").alias("pa"), "end"), "row")
    entries = cut(entries.withColumn("share", (F.col("na") - F.col("pa") + F.col("common")) / F.col("na")))
    pivot = entries.groupBy("hash").agg(F.max(F.struct("share", F.col("na").alias("nb"), F.col("row").alias("to"), F.col("pa").alias("pb"))).alias("x"))
    met_at = entries.join(pivot.select("hash", "x.to", "x.nb", "x.pb"), "hash")
    one = [F.first(c).alias(c) for c in ("na", "pa", "nb", "pb", "end")]
    lists = entries.groupBy("row").agg(F.collect_list("hash").alias("lists"), (F.first("common") - F.count(F.lit(1))).alias("other"))
    return cut(met_at.groupBy("row", "to").agg(F.count(F.lit(1)).alias("n"), *one)), lists


def _tried(met: DataFrame, family: DataFrame, every: DataFrame, percent: int) -> DataFrame:
    """(a, b, n): pairs of short lists with all shared shingles they need, and of each family its spokes, less what parity rules out.

    A spoke is tried on half of what it needs, since pivots differ and short lists are apart.
    """
    shared = met.where("kind = 1").groupBy("a", "b").agg(F.sum("n").alias("n")).withColumn("times", F.lit(1))
    spokes = family.where("row <> to").select(F.least("row", "to").alias("a"), F.greatest("row", "to").alias("b"), "n", F.lit(2).alias("times"))
    pairs = shared.unionByName(spokes).groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("times").alias("times"))
    for k in "ab":
        pairs = pairs.join(every.select(F.col(ROW).alias(k), F.col("n").alias("n" + k), F.col("p").alias("p" + k), *_words(k)), k)
    overlap = _overlap("na", "nb", percent)
    need = F.greatest(F.lit(1), overlap - F.greatest(F.expr("na - pa"), F.expr("nb - pb")))
    pairs = pairs.where(overlap <= F.least("na", "nb")).where(F.col("times") * F.col("n") >= need)
    return cut(pairs.where(_alike(percent)).select("a", "b", "n"))


def _within(family: DataFrame, lists: DataFrame, every: DataFrame, percent: int) -> DataFrame:
    """(a, b) of one family but different components that can still link, by parity and by what their prefixes share.

    The prefix that ends first bounds the overlap: by what lies behind it, the long lists that both are in, and the shingles of
    short lists that both can share.
    """
    mixed = family.groupBy("to").agg(F.min("root").alias("c"), F.max("root").alias("d")).where("c < d").select("to")
    left = family.join(mixed, "to", "left_semi").join(every.select(F.col(ROW).alias("row"), "bits"), "row").join(lists, "row")
    # sizes of linked sets lie within a factor of 100 / percent: a set meets those of its own band of sizes and of the bands beside it
    band = F.floor(F.log(F.col("na").cast("double")) / F.lit(math.log(100.5 / percent)))
    left = left.withColumn("band", band)
    side = lambda k: left.select(
        "to", ("band" if k == "a" else F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")), F.col("row").alias(k), *[F.col(c).alias(c + "_" + k) for c in ("root", "end", "lists", "other")], F.col("na").alias("n" + k), F.expr("na - pa").alias("behind_" + k), *_words(k)
    )
    ends_first = F.when(F.expr("end_a < end_b"), F.col("behind_a")).when(F.expr("end_a > end_b"), F.col("behind_b")).otherwise(F.greatest("behind_a", "behind_b"))
    need = _overlap("na", "nb", percent)
    short_of = need - ends_first - F.least("other_a", "other_b")
    apart = (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & (need <= F.least("na", "nb"))
    quick = short_of <= F.least(F.size("lists_a"), F.size("lists_b"))
    pairs = side("a").join(side("b"), ["to", "band"]).where(apart & quick & _alike(percent) & (short_of <= F.size(F.array_intersect("lists_a", "lists_b"))))
    return pairs.select("a", "b")


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT, short: int = 8
) -> tuple[DataFrame, DataFrame]:
    """(documents: _row, id, n_shingles; members: node, root): nodes are the `_row`s of linked documents."""
    with tidy(docs.sparkSession):
        return _ngram_join(docs, id_col, text_col, size, percent, short)


def _ngram_join(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, short: int) -> tuple[DataFrame, DataFrame]:
    _, total = text_bytes(docs, text_col)
    named = docs.select(F.monotonically_increasing_id().alias(ROW), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    buckets = pieces(total, 16 * MB, 16)
    sent = named.mapInArrow(_sent(frequent(docs, text_col, size), buckets, size, percent, 300_000), ENTRY)
    met = cut(sent.groupBy("bucket").applyInArrow(_met(short), MET))
    every = cut(met.where("kind = 0").select(F.col("a").alias(ROW), F.col("b").alias("id"), "n", "p", "end", F.col("hash").alias("same"), "bits"))
    copies = every.where(F.col("same") != F.col(ROW)).select(F.col(ROW).alias("u"), F.col("same").alias("v"))
    family, lists = _families(met, every)
    tried = _tried(met, family, every, percent)
    drop(met)
    # first each document with the one it shares most with
    ends = tried.select("a", "b", "n").unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    best = ends.groupBy("a").agg(F.max(F.struct("n", "b")).alias("m")).select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")).distinct()
    best = cut(best)
    found = cut(components(copies.unionByName(_links(best, named, size, percent))))
    # then what still stands in different components
    roots = lambda df, c, r: df.join(found.select(F.col("node").alias(c), F.col("root").alias(r)), c, "left").withColumn(r, F.coalesce(r, c))
    rest = roots(roots(tried.join(best, ["a", "b"], "left_anti"), "a", "ra"), "b", "rb").where("ra <> rb").select("a", "b")
    more = _within(roots(family, "row", "root"), lists, every, percent)
    stars = found.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    open_pairs = _thinned(rest.unionByName(more).distinct(), named, every, size, percent)
    links = stars.unionByName(_links(open_pairs, named, size, percent))
    return every.select(ROW, "id", F.col("n").cast("long").alias("n_shingles")), components(links)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """_row, id, n_shingles, component_id, stays: the row of least (id, _row) of each component stays."""
    every, members = ngram_join(docs, id_col, text_col, **kw)
    linked = cut(members.join(every, F.col("node") == F.col(ROW)).select(ROW, "root", "id"))
    named = linked.groupBy("root").agg(F.min(F.struct("id", ROW)).alias("least"))
    placed = linked.join(named, "root").select(ROW, F.col("least.id").alias("first"), F.col(f"least.{ROW}").alias("stays_row"))
    none = F.lit(np.iinfo(np.int64).max)
    unless = lambda c: F.when(c != none, c)
    return every.join(placed, ROW, "left").select(
        ROW,
        unless(F.col("id")).alias("id"),
        "n_shingles",
        unless(F.coalesce("first", "id")).alias("component_id"),
        (F.coalesce("stays_row", ROW) == F.col(ROW)).alias("stays"),
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, less those whose component keeps another row."""
    row, there = free(ROW, docs.columns), free("_gone", docs.columns)
    gone = classes(docs, id_col, text_col).where(~F.col("stays")).select(F.col(ROW).alias(there))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(gone, F.col(row) == F.col(there), "left_anti").drop(row)


#: The same rows by joining every shingle with itself and closing the links: for small tables.
OP9_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
    FROM split
), shingle AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), link AS (
    SELECT a.doc_id AS u, b.doc_id AS v FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
    SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(least(s.doc_id, m.v), s.doc_id) AS component_id
FROM sets s LEFT JOIN (SELECT u, min(v) AS v FROM reach GROUP BY u) m ON s.doc_id = m.u
"""


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
