"""Toxicity scores from a learned lexicon, matched with one edit, and the context of the matches.

Fitting takes at most `sample` labelled rows (the least hashes of their ids), all of them where fewer are labelled. Stems
that toxic texts hold and clean ones lack make the lexicon, all for which the evidence suffices. The lexicon's trie is intersected with the
Levenshtein automaton of each stem: the product is determinised once, so that a token runs through one table, byte by byte,
and ends as an exact match, a match with one edit (stems of five letters and more), or none. Around each match a window of
words gives its context: other matches close by speak for abuse, quotation marks or a reporting colon before it for a
quotation. A logistic regression over these features gives the score.

Cases: null and empty texts have no match and get the model's base score; without labelled rows of both kinds the lexicon
is empty and every score is 0; repeated rows get a row each, null ids are carried and are not held out by a remainder;
other columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm.common import MB, cut, free, lowered, packed, release, sliced, words_of

SAMPLE, WINDOW = 20_000, 12
#: The log-likelihood ratio that chance does not reach among millions of stems.
EVIDENCE = 17.0
STEM_LEAST, STEM_MOST, FUZZY_LEAST = 4, 12, 5
FEATURES = 7
#: Bytes that cannot stand in a term: they are dropped from a token's ends and keep their context meaning.
QUOTES = (b'"', b"'", b"\xc2\xab", b"\xc2\xbb", b"\xe2\x80\x9c", b"\xe2\x80\x9d", b"\xe2\x80\x9e", b"`")
EDGE = np.zeros(256, bool)
EDGE[[c for c in range(128) if not chr(c).isalnum()]] = True
#: Code points beyond ASCII that are marks by their category: punctuation, symbols, separators, controls and format characters.
MARK = np.zeros(0x20000, bool)
MARK[[c for c in range(128, len(MARK)) if unicodedata.category(chr(c))[0] in "PSZ" or unicodedata.category(chr(c)) in ("Cc", "Cf")]] = True


def marks(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to marks: those of EDGE, and all bytes of a longer mark."""
    out = EDGE[raw]
    lead = np.flatnonzero(raw >= 0xC2)
    if not len(lead):
        return out
    more = np.where(raw[lead] >= 0xF0, 3, np.where(raw[lead] >= 0xE0, 2, 1))
    lead, more = lead[lead + more < len(raw)], more[lead + more < len(raw)]
    point = (raw[lead] & (0x3F >> more)).astype(np.int64)
    for k in range(1, 4):
        on = more >= k
        point[on] = (point[on] << 6) | (raw[lead[on] + k] & 0x3F)
    here = MARK[np.minimum(point, len(MARK) - 1)]
    lead, more = lead[here], more[here]
    for k in range(4):
        out[lead[more >= k] + k] = True
    return out


def bare(word: bytes) -> bytes:
    """A word without the marks at its end."""
    at = marks(np.frombuffer(word, np.uint8))
    inside = np.flatnonzero(~at)
    return word[: inside[-1] + 1] if len(inside) else b""


@dataclass
class Automaton:
    """The determinised product of trie and Levenshtein automata: next[state, class of byte], and each state's verdict."""

    classes: np.ndarray
    next: np.ndarray
    verdict: np.ndarray  # 0 none, 1 with one edit, 2 exact


def build_automaton(terms: list[bytes], fuzzy_least: int = FUZZY_LEAST) -> Automaton:
    """Matches any token that begins with a term, or with a string one edit away from a long enough term."""
    symbols = sorted({b for t in terms for b in t})
    classes = np.zeros(256, np.int32)
    for k, b in enumerate(symbols):
        classes[b] = k + 1
    width = len(symbols) + 1
    nodes: list[dict[int, int]] = [{}]
    fuzzy, final = [False], [False]
    for t in terms:  # the trie; a node is open to edits if a long enough term passes through it
        at = 0
        for b in t:
            if b not in nodes[at]:
                nodes[at][b] = len(nodes)
                nodes.append({})
                fuzzy.append(False)
                final.append(False)
            at = nodes[at][b]
            fuzzy[at] |= len(t) >= fuzzy_least
        final[at] = True
    fuzzy[0] = any(len(t) >= fuzzy_least for t in terms)
    long_final = {n for t in terms if len(t) >= fuzzy_least for n in [_walk(nodes, t)]}

    def closed(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """Adds the deletions: a letter of the term that the token lacks."""
        out = set(states)
        for node, edits in states:
            if edits == 0:
                out |= {(child, 1) for child in nodes[node].values() if fuzzy[child]}
        return frozenset(x for x in out if x[1] == 0 or (x[0], 0) not in out)

    def verdict(states: frozenset[tuple[int, int]]) -> int:
        if any(final[n] and e == 0 for n, e in states):
            return 2
        return int(any(n in long_final and e == 1 for n, e in states))

    start = closed({(0, 0)})
    known, todo, table, ends = {frozenset(): 0, start: 1}, [start], {0: [0] * width}, [0, verdict(start)]
    accept = {}
    while todo:
        states = todo.pop()
        row = [0] * width
        for k in range(width):
            b = symbols[k - 1] if k else -1
            out: set[tuple[int, int]] = set()
            for node, edits in states:
                if b in nodes[node]:
                    out.add((nodes[node][b], edits))
                if edits == 0 and fuzzy[node]:
                    out.add((node, 1))  # a letter that the term lacks
                    out |= {(child, 1) for child in nodes[node].values() if fuzzy[child]}  # another letter
            new = closed(out)
            v = verdict(new)
            if v == 2:  # nothing that follows can change an exact match
                new = accept.setdefault(2, frozenset({(-2, 0)}))
            if new not in known:
                known[new] = len(ends)
                ends.append(v)
                if v == 2:
                    table[known[new]] = [known[new]] * width
                else:
                    todo.append(new)
            row[k] = known[new]
        table[known[states]] = row
    return Automaton(classes, np.array([table[k] for k in range(len(ends))], np.int32), np.array(ends, np.int8))


def _walk(nodes: list[dict[int, int]], term: bytes) -> int:
    at = 0
    for b in term:
        at = nodes[at][b]
    return at


def matches(auto: Automaton, raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The best verdict of each token: all tokens advance together, those in a dead or exact state leave."""
    best = np.zeros(len(start), np.int8)
    live = np.arange(len(start))
    state = np.ones(len(start), np.int32)
    at = start.copy()
    while len(live):
        inside = at < stop[live]
        live, state, at = live[inside], state[inside], at[inside]
        state = auto.next[state, auto.classes[raw[at]]]
        v = auto.verdict[state]
        better = v > best[live]
        best[live[better]] = v[better]
        on = (state != 0) & (v != 2)
        live, state, at = live[on], state[on], at[on] + 1
    return best


def trimmed(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens without the marks at their front; marks inside or after a token do not matter to a prefix match."""
    inside = np.flatnonzero(~marks(raw))
    at = np.searchsorted(inside, start)
    first = np.append(inside, len(raw))[at]
    return np.minimum(first, stop), stop


def features(auto: Automaton, raw: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each document: exact and edited matches (log), matches per word, densest window, quoted share, any exact, any edited."""
    n_docs = len(offsets) - 1
    out = np.zeros((n_docs, FEATURES))
    low = lowered(raw)
    start, stop, doc = words_of(low, offsets)
    if not len(start):
        return out
    s, e = trimmed(low, start, stop)
    v = matches(auto, low, s, e)
    hit = np.flatnonzero(v)
    words = np.bincount(doc, minlength=n_docs)
    exact, near = (np.bincount(doc[hit], weights=v[hit] == k, minlength=n_docs) for k in (2, 1))
    weight = np.where(v[hit] == 2, 1.0, 0.25)
    # matches within `window` words of each match, in the same document
    left = np.searchsorted(hit, hit - window)
    right = np.searchsorted(hit, hit + window, side="right")
    bounds = np.searchsorted(doc[hit], np.arange(n_docs + 1))
    left, right = np.maximum(left, bounds[doc[hit]]), np.minimum(right, bounds[doc[hit] + 1])
    sums = np.append(0, np.cumsum(weight))
    dense = np.zeros(n_docs)
    np.maximum.at(dense, doc[hit], sums[right] - sums[left])
    quoted = np.array([_quoted(low, start, stop, doc, int(h)) for h in hit.tolist()], float) if len(hit) else np.zeros(0)
    share = np.bincount(doc[hit], weights=quoted, minlength=n_docs) / np.maximum(1, exact + near)
    out[:, 0], out[:, 1] = np.log1p(exact), np.log1p(near)
    out[:, 2] = np.minimum(1, 20 * (exact + 0.25 * near) / np.maximum(1, words))
    out[:, 3], out[:, 4] = np.log1p(dense), share
    out[:, 5], out[:, 6] = exact > 0, (near > 0) & (exact == 0)
    return out


def _quoted(raw: np.ndarray, start: np.ndarray, stop: np.ndarray, doc: np.ndarray, word: int, reach: int = 3) -> bool:
    """Whether a match stands between quotation marks at most `reach` words away, or follows a colon closely."""
    a, b = max(0, word - reach), min(len(start) - 1, word + reach)
    while doc[a] != doc[word]:
        a += 1
    while doc[b] != doc[word]:
        b -= 1
    before = raw[start[a] : start[word] + 3].tobytes()
    after = raw[max(start[word], stop[word] - 3) : stop[b]].tobytes()
    return any(q in before for q in QUOTES) and any(q in after for q in QUOTES) or b":" in before[:-3]


@dataclass
class Model:
    auto: Automaton | None = None
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    terms: list[bytes] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.auto is None:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(x / self.scale @ self.weights[1:] + self.weights[0], -30, 30)))


def stem_counts(texts: list[bytes], toxic: list[int]) -> dict[bytes, list[int]]:
    """In how many toxic and how many other texts each stem (the first letters of a word, and a longer word itself) stands."""
    out: dict[bytes, list[int]] = {}
    for text, y in zip(texts, toxic):
        raw = lowered(np.frombuffer(text, np.uint8))
        if not len(raw):
            continue
        start, stop, _ = words_of(raw, np.array([0, len(raw)]))
        s, e = trimmed(raw, start, stop)
        whole = raw.tobytes()
        words = {whole[a:b] for a, b in zip(s.tolist(), e.tolist()) if b - a >= STEM_LEAST}
        stems = {w[:k] for w in words for k in range(STEM_LEAST, min(len(w), STEM_MOST) + 1)}
        for w in stems | {bare(w) for w in words if len(w) > STEM_MOST}:
            out.setdefault(w, [0, 0])[0 if y else 1] += 1
    return out


def evidence(a: float, b: float, base: float) -> float:
    """The log-likelihood ratio of a toxic and b other texts against a share of `base`."""
    p = a / (a + b)
    return a * math.log(p / base) + (b * math.log((1 - p) / (1 - base)) if b else 0)


def choose_terms(counts: dict[bytes, tuple[int, int]], n_yes: int, n_no: int) -> list[bytes]:
    """Stems of enough evidence, nearly pure ones only; of stems that stand for nearly the same texts the longest."""
    if not n_yes or not n_no:
        return []
    base = n_yes / (n_yes + n_no)
    count = {w: a for w, (a, b) in counts.items() if a >= 3 and a >= 9 * b and (w[-1] & 0xC0) != 0xC0 and evidence(a, b, base) >= EVIDENCE and bare(w) == w}
    by_stem = defaultdict(list)
    for w in sorted(count):
        by_stem[w[:STEM_LEAST]].append(w)
    chosen: set[bytes] = set()
    for group in by_stem.values():
        have = set(group)
        for w in group:
            if any(w[:k] in have for k in range(STEM_LEAST, len(w))):
                continue
            while True:
                longer = [x for x in group if len(x) == len(w) + 1 and x.startswith(w) and count[x] >= 0.8 * count[w]]
                if not longer:
                    break
                w = longer[0]
            chosen.add(w)
    return sorted(chosen)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str = "doc_id", folds: int = 5) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """A model from at most `sample` labelled rows (id, toxic) of the training folds.

    Texts stay on the executors: they send stem counts, of which the driver takes those with enough evidence, and then a
    few numbers for each sampled row. Stems are counted in distinct texts, so copies of one text weigh once.
    """
    few = (
        labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64(id_col), id_col).limit(sample)
    )
    rows = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(few), id_col).select("text", F.col("toxic").cast("int").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", MB):
            raw, offsets = packed(batch.column("text"))
            whole = raw.tobytes()
            found = stem_counts([whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], batch.column("toxic").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
                names=["stem", "a", "b"],
            )
            del batch, raw, whole, found
        release()

    once = cut(rows.groupBy("text").agg(F.max("toxic").alias("toxic")))
    kinds = {r[0]: r[1] for r in once.groupBy("toxic").count().collect()}
    n_yes, n_no = kinds.get(1, 0), kinds.get(0, 0)
    if not n_yes or not n_no:
        return Model()
    strong = once.mapInArrow(count, "stem binary, a long, b long").groupBy("stem").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
    base = n_yes / (n_yes + n_no)
    ratio = F.expr(f"a * ln(a / (a + b) / {base}D) + if(b > 0, b * ln(b / (a + b) / {1 - base}D), 0)")
    # a little slack, as the driver decides; what passes is bounded by the sample
    strong = strong.where("a >= 3 and a >= 9 * b").where(ratio >= EVIDENCE - 1e-6)
    lexicon = choose_terms({bytes(r[0]): (r[1], r[2]) for r in strong.collect()}, n_yes, n_no)
    if not lexicon:
        return Model()
    auto = build_automaton(lexicon)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 2 * MB):
            x = features(auto, *packed(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])
        release()

    got = rows.mapInArrow(measured, "x array<double>, toxic int").toArrow()
    x = np.array(got.column("x").to_pylist()).reshape(-1, FEATURES)
    toxic = got.column("toxic").to_numpy().astype(float)
    order = np.lexsort((*x.T, toxic))
    x, toxic = x[order], toxic[order]
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    return Model(auto, _logistic(x / scale, toxic), scale, lexicon)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of `docs` plus score double and n_hits long; the model, a bounded lexicon, travels with the function.

    Where `docs` has a column of such a name, the one added gets an underscore.
    """
    m, names = model, docs.columns
    first, second = free("score", names), free("n_hits", names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, 2 * MB):
            x = features(m.auto, *packed(batch.column(text_col))) if m.auto is not None else np.zeros((batch.num_rows, FEATURES))
            hits = np.rint(np.expm1(x[:, 0]) + np.expm1(x[:, 1])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.score(x)), pa.array(hits)], names=[*names, first, second])
            del batch
        release()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, `{first}` double, `{second}` long")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits")
