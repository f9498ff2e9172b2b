"""Ranked lexical search by sort-based accumulation: the k best documents for each item of a query table.

Two passes over the documents, none of which moves a text. The first sums how many documents hold each query term, how
many hold any term, and how many terms there are. The second concatenates, for a slice of documents, the arrays of matched
(item, document, impact), packs item and document into one key, sorts the keys by radix and sums the impacts of equal keys
(`numpy.add.reduceat`). A bounded heap for each item keeps a task's best. The heaps' rows are dealt by ranges of (item,
score, id), so that what many tasks found for one item is cut to k in many places before the last ranking meets it.

Queries go along with the tasks in blocks of at most about `BLOCK` bytes of their texts; a larger query table means more
passes, never a larger broadcast. A single longer item is a block of its own.

Cases: null and empty texts hold no term, on both sides: such a document is never found and such an item finds nothing. Ties
go by ascending id, null ids last. Repeated documents are found each, a repeated item gets its list once for each of its
rows. Empty tables give an empty result; other columns are not read. A long text is a slice of its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchwright.llm.common import MB, cut, lowered, packed, pieces, release, runs_of, sliced, table, text_bytes, word_hashes

TOP, BLOCK = 50, 4 * MB
SLICE, TRIPLES = MB // 2, 2_000_000
FOUND = "item int, score long, doc long"
#: Bytes of a term: digits, letters, and whatever is not ASCII.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Queries:
    """A block of items: its distinct terms, ascending, and of each the items that hold it (`item[edge[t] : edge[t + 1]]`)."""

    ids: list
    terms: np.ndarray
    edge: np.ndarray
    item: np.ndarray

    @staticmethod
    def of(ids: list, texts: pa.Array) -> Queries:
        item, h = terms_of(texts)
        order = np.lexsort((item, h))
        item, h = item[order], h[order]
        new = np.append(True, (item[1:] != item[:-1]) | (h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
        item, h = item[new], h[new]
        terms, first = np.unique(h, return_index=True)
        return Queries(ids, terms, np.append(first, len(h)), item)

    def postings(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(terms of each document, and of each query term in a document: document, term, occurrences), by document and term."""
        doc, h = terms_of(texts)
        n = np.bincount(doc, minlength=len(texts))
        none = np.zeros(0, np.int64)
        if not len(h) or not len(self.terms):
            return n, none, none, none
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        hit = self.terms[at] == h
        key = np.sort(doc[hit] * len(self.terms) + at[hit])
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else none
        return n, key[first] // len(self.terms), key[first] % len(self.terms), np.diff(np.append(first, len(key)))


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every term of the texts."""
    raw, offsets = packed(texts)
    raw = lowered(raw)
    start, stop, doc = runs_of(~TERM[raw], offsets)
    return doc, word_hashes(raw, start, stop)


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order that sorts keys of at least 0, by 16-bit digits from the lowest: each pass is stable and linear."""
    order = None
    for shift in range(0, max(1, int(keys.max()).bit_length() if len(keys) else 1), 16):
        digit = ((keys if order is None else keys[order]) >> shift & 0xFFFF).astype(np.uint16)
        step = np.argsort(digit, kind="stable")
        order = step if order is None else order[step]
    return order


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence count gives, by the lengths of the documents; 64-bit integers, division rounding down."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 63:
        m = np.array([50 + (50 * int(x) * n_docs) // n_terms for x in n], np.int64)
    else:
        m = 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def accumulated(doc: np.ndarray, term: np.ndarray, impact: np.ndarray, q: Queries, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(item, document, score) of the postings: matched triples by radix sort of packed keys and sums over equal keys."""
    many = np.diff(q.edge)[term]
    value = weights[term] * impact
    ends = np.cumsum(many)
    start = 0
    while start < len(doc):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TRIPLES, side="right"))
        if stop < len(doc):  # whole documents only
            stop = int(np.searchsorted(doc, doc[max(start, stop - 1)]))
            stop = stop if stop > start else int(np.searchsorted(doc, doc[start], side="right"))
        m, low = many[start:stop], int(doc[start])
        place = np.repeat(q.edge[term[start:stop]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        key = np.repeat(doc[start:stop] - low, m) * len(q.ids) + q.item[place]
        order = radix_order(key)
        key, worth = key[order], np.repeat(value[start:stop], m)[order]
        if len(key):
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            score = np.add.reduceat(worth, first)
            good = score > 0
            yield key[first][good] % len(q.ids), key[first][good] // len(q.ids) + low, score[good]
        start = stop


class Best:
    """The k best of each item so far: heaps of (score, id order), the worst first."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.heaps = k, [[] for _ in range(items)]
        self.bar, self.last = np.zeros(items, np.int64), np.full(items, np.iinfo(np.int64).max)

    def add(self, item: np.ndarray, ids: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        may = (score > self.bar[item]) | ((score == self.bar[item]) & ~null & (ids < self.last[item]))
        touched = set()
        for i, d, no, s in zip(item[may].tolist(), ids[may].tolist(), null[may].tolist(), score[may].tolist()):
            heap, entry = self.heaps[i], (s, (0, 0) if no else (1, -d))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            touched.add(i)
        for i in touched:
            if len(self.heaps[i]) == self.k:
                worst = self.heaps[i][0]
                self.bar[i], self.last[i] = worst[0], -worst[1][1] if worst[1][0] else np.iinfo(np.int64).max

    def rows(self) -> pa.RecordBatch:
        flat = [(i, s, -o[1] if o[0] else None) for i, heap in enumerate(self.heaps) for s, o in heap]
        cols = zip(*flat) if flat else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "score", "doc"])


def _counting(q: Queries):
    """Rows (term, n): documents with each query term; -1: documents with a term, -2: terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, terms = np.zeros(len(q.terms), np.int64), 0, 0
        for batch in sliced(batches, "text", SLICE):
            n, _, term, _ = q.postings(batch.column("text"))
            df += np.bincount(term, minlength=len(df))
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
        there = np.flatnonzero(df)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(np.append([-1, -2], there)), pa.array(np.append([docs, terms], df[there]))], names=["term", "n"])

    return run


def _scoring(q: Queries, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(q.ids), k)
        for batch in sliced(batches, "text", SLICE):
            n, doc, term, tf = q.postings(batch.column("text"))
            if not len(doc):
                continue
            ids = batch.column("doc")
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for item, d, score in accumulated(doc, term, impacts(tf, n[doc], n_docs, n_terms), q, weights):
                best.add(item, ids[d], null[d], score)
        release()
        yield best.rows()

    return run


def _searched(docs: DataFrame, q: Queries, k: int) -> DataFrame:
    """(item, score, doc, rank) for one block of items; item counts within it."""
    counts = docs.select("text").mapInArrow(_counting(q), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(counts.column("term").to_pylist(), counts.column("n").to_pylist()))
    n_docs, n_terms = found.pop(-1, 0), found.pop(-2, 0)
    weights = np.zeros(len(q.terms), np.int64)
    for term, df in found.items():
        weights[term] = weight(df, n_docs)
    rows = cut(docs.mapInArrow(_scoring(q, weights, n_docs, n_terms, k), FOUND))  # the ranges are sampled from it, so it is read twice
    order = (F.desc("score"), F.asc_nulls_last("doc"))
    spread = rows.repartitionByRange("item", *order)
    return spread.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """(item_id, rank int, doc_id, score): the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    named = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    blocks = pieces(text_bytes(asked)[1], block)
    out = []
    for b in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        got = part.toArrow().combine_chunks()
        if not got.num_rows:
            continue
        q = Queries.of(got.column("id").to_pylist(), pa.concat_arrays(got.column("text").chunks))
        names = spark.createDataFrame([(i, x) for i, x in enumerate(q.ids)], f"item int, id {asked.schema['id'].dataType.simpleString()}")
        out.append(_searched(named, q, k).join(F.broadcast(names), "item").select(F.col("id").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score"))
    if not out:
        return spark.createDataFrame([], f"item_id {asked.schema['id'].dataType.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, out)


OP12_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), total AS (
    SELECT CAST(count(*) FILTER (WHERE len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM words
), posting AS (
    SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM words) GROUP BY doc_id, term
), weighted AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), total
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN posting USING (term) JOIN weighted USING (term), total GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 50
"""


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
