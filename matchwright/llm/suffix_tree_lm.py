"""A probabilistic suffix tree over words, and scores of whole texts by it.

Tokens are words, and one end for each text; their events are the words of the training texts and one unknown word. The
tree's alphabet is every word that the training texts hold `REPEATED` times at any size of the corpus, one symbol for all
other words, a begin and an end. A context of up to `DEPTH` symbols that is seen `LEAST` times, at any size of the corpus, is retained when its
next-symbol distribution diverges from that of the context one symbol shorter (count times Kullback-Leibler divergence
above a threshold), and with it all its suffixes. Distributions are smoothed towards the shorter context in proportion to
the number of symbols seen after it (Witten-Bell); a token is scored by the longest retained suffix of what precedes it.
Every pair of context and symbol counts, those seen once too. A word that is no symbol of its own shares the probability
of the common symbol by its count, less a discount that goes to the unknown word, so the events after any context sum to one.

The model is never in one place. Texts are dealt into parts and written once as their words; then everything is counted by blob exchanges: a part sends the
hashes and training counts of its distinct items by bucket, and a bucket returns the corpus counts of what it was asked
for. Words come first, then runs of two symbols, then those of three and four; a run is asked for only where the context in
it can have `LEAST` occurrences, which loses none, as a run is seen no more often than what it holds. The count of a run is
both that of a context and that of a (context, symbol) pair. A last exchange sums for each context what its occurrences
give: one over the pair's count (the number of symbols seen after it) and the logarithm of the two shares (the
divergence). The driver sees sums only.

Cases: a null or empty text is its end alone; without training rows all events are uniform and the base is as its formula
says; rows that repeat count each time; a null id trains. A text of any length is in one part. Ties do not arise: counts and
sums decide. Empty tables give empty results; other columns are not read. Words, runs and contexts are told apart by 64-bit
hashes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm.common import BASE_A, BASE_B, MB, cut, distinct, drop, lowered, mix, packed, pieces, text_bytes, word_hashes, words_of

DEPTH = 3
REPEATED, LEAST, DIVERGES = 2, 20, 12.0
BEGIN, OTHER, END, FIRST = 0, 1, 2, 3  # symbols; words from FIRST on
SENT = "kind int, bucket int, part int, keys binary, counts binary"
WORDS, TWOS, LONGER, WEIGHED = 0, 10, 11, 12  # what a part is told


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets begin and end in sorted keys: a bucket is a range of hashes."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))


def _zipped(*values: np.ndarray) -> bytes:
    return pa.compress(b"".join(x.tobytes() for x in values), codec="zstd", asbytes=True)


def _coded(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of all of them: the high bytes of hashes that lie close vanish."""
    step = np.diff(keys, prepend=np.uint64(0))
    return len(keys).to_bytes(4, "little") + pa.compress(step.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _decoded(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    step = np.frombuffer(pa.decompress(blob[4:], 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(step.T).view(np.uint64).ravel(), dtype=np.uint64)


def _unzipped(blob: bytes, size: int) -> bytes:
    return pa.decompress(blob, size, codec="zstd", asbytes=True)


def _planes(x: np.ndarray) -> bytes:
    """Small numbers, byte by byte of all of them: the high bytes are mostly zero, and the low ones alike."""
    return _zipped(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _flat(blob: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unzipped(blob, 4 * n), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _gathered(kind: str, ident: str):
    """A part's texts as one row: ids, training flags, words of each text, distinct word hashes, and each token's word by its frequency."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        raw, offsets = packed(t.column("text").chunk(0))
        raw = lowered(raw)
        start, stop, doc = words_of(raw, offsets)
        u, _, word = distinct(word_hashes(raw, start, stop))
        order = np.argsort(-np.bincount(word, minlength=len(u)), kind="stable")
        rank = np.empty(len(u), np.int64)
        rank[order] = np.arange(len(u))
        return pa.table(
            {
                "part": t.column("part").slice(0, 1),
                "n": pa.array([t.num_rows], pa.int64()),
                "ids": pa.ListArray.from_arrays([0, t.num_rows], t.column(ident).chunk(0)),
                "train": pa.ListArray.from_arrays([0, t.num_rows], t.column("train").chunk(0)),
                "sizes": pa.array([_planes(np.bincount(doc, minlength=t.num_rows))], pa.binary()),
                "tokens": pa.array([len(word)], pa.int64()),
                "words": pa.array([_coded(u)], pa.binary()),
                "order": pa.array([_planes(order)], pa.binary()),
                "word": pa.array([_planes(rank[word])], pa.binary()),
            }
        )

    return run, f"part int, n long, ids array<{kind}>, train array<boolean>, sizes binary, tokens long, words binary, order binary, word binary"


class Texts:
    """A part's row, read: distinct word hashes, each token's word, each token's text, and which texts are learnt from."""

    def __init__(self, t: pa.Table) -> None:
        get = lambda c: t.column(c)[0].as_py()
        self.part, self.n = get("part"), get("n")
        self.words = _decoded(get("words"))
        self.word = _flat(get("order"), len(self.words))[_flat(get("word"), get("tokens"))]
        self.doc = np.repeat(np.arange(self.n), _flat(get("sizes"), self.n))
        self.ids, self.flags = (t.column(c).combine_chunks().flatten() for c in ("ids", "train"))
        self.train = self.flags.to_numpy(zero_copy_only=False).astype(bool)


def _sent(buckets: int):
    """Words and their training counts, from the parts' rows."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                texts, out = Texts(pa.Table.from_batches([batch.slice(i, 1)])), _none()
                counts = np.bincount(texts.word, weights=texts.train[texts.doc].astype(np.float64), minlength=len(texts.words)).astype(np.int64)
                _put(out, 0, texts.part, buckets, texts.words, counts.astype(np.uint32))
                for k, v in zip(out, (2, 0, texts.part, b"", np.array([texts.train.sum()], np.int64).tobytes())):
                    out[k].append(v)
                yield from _table(out).to_batches()

    return run


def _met(t: pa.Table) -> pa.Table:
    """Kind 0: corpus counts of the words of (part, bucket), in their order. 1: see sorted_out. 2: tokens, distinct, ends."""
    kind = t.column("kind").to_numpy()
    keys, counts, part = t.column("keys").to_pylist(), t.column("counts").to_pylist(), t.column("part").to_numpy()
    bucket, out = t.column("bucket")[0].as_py(), []
    mine = np.flatnonzero(kind == 0)
    if len(mine):
        held = [_decoded(keys[i]) for i in mine]
        u, _, inv = distinct(np.concatenate(held))
        total = np.bincount(inv, weights=np.concatenate([np.frombuffer(_unzipped(counts[i], 4 * len(k)), np.uint32) for i, k in zip(mine, held)]), minlength=len(u)).astype(np.int64)
        at = 0
        for i, k in zip(mine, held):
            n = len(k)
            out.append((0, bucket, int(part[i]), b"", _zipped(total[inv[at : at + n]])))
            at += n
        spread = np.bincount(np.minimum(total[total > 0], REPEATED + 1), weights=total[total > 0], minlength=REPEATED + 2)
        kinds = np.bincount(np.minimum(total[total > 0], REPEATED + 1), minlength=REPEATED + 2)
        out.append((1, bucket, -1, b"", np.array([spread[:REPEATED].sum(), kinds[:REPEATED].sum(), kinds[1], kinds[2], kinds[REPEATED:].sum()], np.int64).tobytes()))
        out.append((2, bucket, -1, b"", np.array([total.sum(), (total > 0).sum(), 0], np.int64).tobytes()))
    for i in np.flatnonzero(kind == 2):
        out.append((2, bucket, -1, b"", np.array([0, 0, np.frombuffer(counts[i], np.int64)[0]], np.int64).tobytes()))
    cols = list(zip(*out))
    return pa.table({"kind": pa.array(cols[0], pa.int32()), "bucket": pa.array(cols[1], pa.int32()), "part": pa.array(cols[2], pa.int32()), "keys": pa.array(cols[3], pa.binary()), "counts": pa.array(cols[4], pa.binary())})


def _put(out: dict[str, list], kind: int, part: int, buckets: int, keys: np.ndarray, *values: np.ndarray) -> None:
    """Adds a row for each bucket of the sorted keys: them, and their values one array after the other."""
    bounds = _bounds(keys, buckets)
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        i, j = bounds[b], bounds[b + 1]
        for k, v in zip(out, (kind, b, part, _coded(keys[i:j]), _zipped(*[x[i:j] for x in values]))):
            out[k].append(v)


def _table(out: dict[str, list]) -> pa.Table:
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))})


def _none() -> dict[str, list]:
    return {"kind": [], "bucket": [], "part": [], "keys": [], "counts": []}


def _told(right: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """What the buckets answered to a part's keys."""
    out = np.zeros(len(keys), np.int64)
    if len(keys):
        bounds = _bounds(keys, buckets)
        for k, b, blob in zip(right.column("kind").to_pylist(), right.column("bucket").to_pylist(), right.column("counts").to_pylist()):
            if k == kind:
                i, j = bounds[b], bounds[b + 1]
                out[i:j] = np.frombuffer(_unzipped(blob, 8 * int(j - i)), np.int64)
    return out


@dataclass
class Corpus:
    """What the driver knows: tokens, distinct events and ends; tokens and kinds of the other words, their discount; words that are symbols."""

    tokens: int
    kinds: int
    ends: int
    other_n: int
    other_v: int
    off: float
    symbols: int

    @property
    def alphabet(self) -> int:
        return FIRST + self.symbols


class Part:
    """The symbols of a part's texts in a row, each text between a begin and an end, and the counts told so far."""

    def __init__(self, t: pa.Table, right: pa.Table, corpus: Corpus, buckets: int) -> None:
        self.right, self.corpus, self.buckets = right, corpus, buckets
        self.texts = Texts(t)
        u, self.inv, self.doc = self.texts.words, self.texts.word, self.texts.doc
        self.count = _told(right, WORDS, u, buckets)
        often = self.count >= REPEATED
        self.symbol = np.where(often, u, np.uint64(OTHER))
        n = self.texts.n
        size = np.bincount(self.doc, minlength=n) + 2
        base = np.append(0, np.cumsum(size))[:-1]
        self.row = np.full(int(size.sum()), END, np.uint64)
        self.row[base] = BEGIN
        place = base[self.doc] + 1 + np.arange(len(self.doc)) - (base - 2 * np.arange(n))[self.doc]
        self.row[place] = self.symbol[self.inv]
        self.text = np.repeat(np.arange(n), size)
        self.token = np.ones(len(self.row), bool)
        self.token[base] = False
        self.word = np.zeros(len(self.row), bool)
        self.word[place] = often[self.inv]
        self.train = self.texts.train[self.text] & self.token
        one = np.full(len(self.row), corpus.ends, np.int64)
        one[place] = np.where(often, self.count, corpus.other_n)[self.inv]
        # counts[L] and keys[L]: of the L symbols that end here, the nearest first in the key; known[d]: the d symbols before are a context
        self.counts = [None, one, *[np.zeros(len(self.row), np.int64) for _ in range(DEPTH)]]
        far = mix(self.row + np.uint64(BASE_B))
        self.keys = [None, far]
        for k in range(1, DEPTH + 1):
            self.keys.append(mix(self.keys[-1] * np.uint64(BASE_A) + self.before(far, k)))
        self.known = [self.token, self.token & (self.before(one, 1) >= LEAST)]

    @staticmethod
    def before(x: np.ndarray, k: int) -> np.ndarray:
        """Each place has what stands k places before; what wraps around is never looked at."""
        return np.roll(x, k)

    def extend(self, length: int) -> None:
        """Marks the contexts of `length` symbols that are seen often enough, or can be where their count is not told yet."""
        inner = self.token & self.before(self.word, 1) & self.before(self.known[length - 1], 1)
        self.known.append(inner & (self.before(self.counts[length], 1) >= LEAST))

    def asked(self, *lengths: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(distinct keys, index of each place among them, places) of the runs of such lengths."""
        places = [np.flatnonzero(self.known[n - 1]) for n in lengths]
        u, _, inv = distinct(np.concatenate([self.keys[n][at] for n, at in zip(lengths, places)]))
        return u, inv, places

    def twos(self):
        return self.asked(2)

    def longer(self):
        """Runs of three, and those of four whose two inner contexts of two are known."""
        self.learn(TWOS, self.twos(), 2)
        self.extend(2)
        self.known.append(self.known[2] & self.before(self.known[2], 1) & self.before(self.word, 1))
        return self.asked(3, 4)

    def learn(self, kind: int, asked: tuple, *lengths: int) -> None:
        u, inv, places = asked
        n, at = _told(self.right, kind, u, self.buckets)[inv], 0
        for length, place in zip(lengths, places):
            self.counts[length][place] = n[at : at + len(place)]
            at += len(place)

    def whole(self) -> None:
        """All counts, and the contexts that are seen often enough."""
        self.learn(LONGER, self.longer(), 3, 4)
        del self.known[3]
        self.extend(3)

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """(distinct keys of contexts, first occurrence among the places, index of each place, places by length)."""
        places = [np.flatnonzero(self.known[d]) for d in range(1, DEPTH + 1)]
        u, first, inv = distinct(np.concatenate([self.keys[d + 1][at - 1] for d, at in enumerate(places)]))
        return u, first, inv, places

    def seen(self, d: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(occurrences of the symbol after its context of d symbols, of that context)."""
        return self.counts[d + 1][at], self.counts[d][at - 1] if d else np.full(len(at), self.corpus.tokens)


def _asking(what: str, corpus: Corpus, buckets: int):
    """A part asks for the counts of its runs, and gives its own."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = _none()
        if left.num_rows:
            part = Part(left, right, corpus, buckets)
            u, inv, places = getattr(part, what)()
            n = np.bincount(inv, weights=part.train[np.concatenate(places)], minlength=len(u))
            _put(out, 0, left.column("part")[0].as_py(), buckets, u, n.astype(np.uint32))
        return _table(out)

    return run


def _answered(kind: int):
    def run(t: pa.Table) -> pa.Table:
        keys, counts, part = t.column("keys").to_pylist(), t.column("counts").to_pylist(), t.column("part").to_pylist()
        out, at = _none(), 0
        keys = [_decoded(x) for x in keys]
        u, _, inv = distinct(np.concatenate(keys))
        total = np.bincount(inv, weights=np.concatenate([np.frombuffer(_unzipped(x, 4 * len(k)), np.uint32) for k, x in zip(keys, counts)]), minlength=len(u)).astype(np.int64)
        for x, p in zip(keys, part):
            n = len(x)
            for k, v in zip(out, (kind, t.column("bucket")[0].as_py(), p, b"", _zipped(total[inv[at : at + n]]))):
                out[k].append(v)
            at += n
        return _table(out)

    return run


def _weighing(corpus: Corpus, buckets: int):
    """A part sends for each of its contexts: the shorter one, and its share of the number of symbols and of the divergence."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = _none()
        if left.num_rows:
            part = Part(left, right, corpus, buckets)
            part.whole()
            u, first, inv, places = part.contexts()
            above, kinds, gain = [], [], []
            for d, at in enumerate(places, 1):
                (n, total), (m, whole), learnt = part.seen(d, at), part.seen(d - 1, at), part.train[at]
                above.append(part.keys[d - 1][at - 1] if d > 1 else np.zeros(len(at), np.uint64))
                n, m = np.maximum(n, 1), np.maximum(m, 1)  # those not seen do not weigh
                kinds.append(learnt / n)
                gain.append(learnt * np.log(n / total * (whole / m)) if len(at) else np.zeros(0))
            sums = [np.bincount(inv, weights=np.concatenate(x), minlength=len(u)) for x in (kinds, gain)]
            # a retained context gains in some part, which names the shorter one
            _put(out, 0, left.column("part")[0].as_py(), buckets, u, np.where(sums[1] > 0, np.concatenate(above)[first], 0), *[x.astype(np.float32) for x in sums])
        return _table(out)

    return run


def _split(key: bytes, blob: bytes, kept: type = np.float64) -> tuple[np.ndarray, ...]:
    """(contexts, the shorter ones, numbers of symbols, divergences) of a row."""
    keys = _decoded(key)
    n, wide = len(keys), np.dtype(kept).itemsize
    blob = _unzipped(blob, (8 + 2 * wide) * n)
    return keys, np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, kept, n, 8 * n), np.frombuffer(blob, kept, n, (8 + wide) * n)


def _weighed(t: pa.Table) -> pa.Table:
    """A bucket's contexts in one row: the shorter ones, the numbers of symbols and the divergences; and what each part asked about."""
    keys, above, kinds, gain = (np.concatenate(x) for x in zip(*[_split(k, c, np.float32) for k, c in zip(t.column("keys").to_pylist(), t.column("counts").to_pylist())]))
    u, _, inv = distinct(keys)
    up = np.zeros(len(u), np.uint64)
    up[inv[above > 0]] = above[above > 0]
    kinds, gain = (np.bincount(inv, weights=x, minlength=len(u)) for x in (kinds, gain))
    bucket = t.column("bucket")[0].as_py()
    out = {"kind": [0], "bucket": [bucket], "part": [-1], "keys": [_coded(u)], "counts": [_zipped(up, np.rint(kinds), gain)]}
    for key, part in zip(t.column("keys").to_pylist(), t.column("part").to_pylist()):
        for k, v in zip(out, (1, bucket, part, _coded(np.searchsorted(u, _decoded(key)).astype(np.uint64)), b"")):  # places: a fifth of the keys
            out[k].append(v)
    return _table(out)


def _lifting(buckets: int):
    """The contexts one shorter than a retained one."""

    def run(batches):
        for batch in batches:
            for key, blob in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                _, above, _, gain = _split(key, blob)
                u = np.unique(above[(gain >= DIVERGES) & (above > 0)])
                out = _none()
                _put(out, 1, -1, buckets, u)
                yield from _table(out).to_batches()

    return run


def _lifted(left: pa.Table, right: pa.Table) -> pa.Table:
    """With a retained context the one that is one symbol shorter is retained."""
    out = _none()
    for key, blob in zip(left.column("keys").to_pylist(), left.column("counts").to_pylist()):
        u, above, kinds, gain = _split(key, blob)
        up = [_decoded(x) for x in right.column("keys").to_pylist()]
        gain = np.where(np.isin(u, np.concatenate(up)), np.inf, gain) if up else gain
        for k, v in zip(out, (0, left.column("bucket")[0].as_py(), -1, key, _zipped(above, kinds, gain))):
            out[k].append(v)
    return _table(out)


def _judged(left: pa.Table, right: pa.Table) -> pa.Table:
    """Tells each part the number of symbols after each of its contexts, negative where the context is not retained."""
    out = _none()
    if left.num_rows:
        _, _, kinds, gain = _split(right.column("keys")[0].as_py(), right.column("counts")[0].as_py())
        value = np.where(gain >= DIVERGES, kinds, -kinds).astype(np.int64)
        for key, p in zip(left.column("keys").to_pylist(), left.column("part").to_pylist()):
            for k, v in zip(out, (WEIGHED, left.column("bucket")[0].as_py(), p, b"", _zipped(value[_decoded(key).astype(np.int64)]))):
                out[k].append(v)
    return _table(out)


def _scored(corpus: Corpus, buckets: int, ident: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({ident: pa.array([], left.schema.field("ids").type.value_type), **{k: pa.array([], v) for k, v in (("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))}})
        part = Part(left, right, corpus, buckets)
        n = part.texts.n
        part.whole()
        count, inv, doc = part.count, part.inv, part.doc
        under = corpus.tokens + 0.1 * (corpus.kinds + 1)
        logs = np.log10((count + 0.1) / under)
        # a word's share of its symbol
        off = corpus.off
        within = np.where(count > 0, count - off, off * corpus.other_v + 1) / (corpus.other_n + 1) if corpus.other_v else np.ones(len(count))
        share = np.where(part.symbol == OTHER, np.log10(np.where(part.symbol == OTHER, within, 1)), 0.0)
        # each symbol after the empty context, then after ever longer ones; the longest retained one counts
        kinds = corpus.symbols + int(corpus.other_n > 0) + int(corpus.ends > 0)
        smooth = (part.counts[1] + max(kinds, 1) / (corpus.alphabet - 1)) / (corpus.tokens + max(kinds, 1))
        best, at = smooth.copy(), 0
        u, _, index, places = part.contexts()
        told = _told(right, WEIGHED, u, buckets)[index]
        for d, place in enumerate(places, 1):
            k, (seen, total) = told[at : at + len(place)], part.seen(d, place)
            at += len(place)
            smooth[place] = (seen + np.abs(k) * smooth[place]) / (total + np.abs(k))
            best[place[k > 0]] = smooth[place[k > 0]]
        steps = np.bincount(part.text[part.token], weights=np.log10(best[part.token]), minlength=n)
        words = np.bincount(doc, minlength=n)
        sums = lambda x: np.bincount(doc, weights=x[inv], minlength=n)
        return pa.table(
            {
                ident: part.texts.ids,
                "train": part.texts.flags,
                "n_tokens": pa.array(words + 1),
                "n_known": pa.array(np.rint(sums((count > 0).astype(float))).astype(np.int64) + int(corpus.ends > 0)),
                "base_score": pa.array(sums(logs) + np.log10((corpus.ends + 0.1) / under)),
                "score": pa.array(steps + sums(share)),
            }
        )

    return run


#: Spark's own setting: exchanges of a finished job are deleted at once. Every step here ends in a checkpoint and is not run again.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def suffix_tree_scores(docs: DataFrame, train: F.Column, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 6 * MB) -> DataFrame:
    """id, train boolean, n_tokens, n_known, train_tokens, base_score, score; `train` says which rows to learn from."""
    conf = docs.sparkSession.conf
    before = conf.get(TIDY, "false")
    conf.set(TIDY, "true")
    try:
        return _suffix_tree_scores(docs, train, id_col, text_col, part_bytes)
    finally:
        conf.set(TIDY, before)


def _suffix_tree_scores(docs: DataFrame, train: F.Column, id_col: str, text_col: str, part_bytes: int) -> DataFrame:
    _, size = text_bytes(docs, text_col)
    parts, buckets = pieces(size, part_bytes, 12), pieces(size, 8 * MB, 16)
    of_id = docs.schema[id_col].dataType.simpleString()
    placed = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"), train.alias("train"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64(F.lit(5), id_col, "text"), F.lit(parts)).cast("int"))
    texts = cut(placed.groupBy("part").applyInArrow(*_gathered(of_id, id_col)))
    met = cut(texts.mapInArrow(_sent(buckets), SENT).groupBy("bucket").applyInArrow(_met, SENT))

    def stats(batches):
        for batch in batches:
            x = [np.frombuffer(b, np.int64) for b in batch.column("counts").to_pylist()]
            s = np.sum(x, axis=0) if x else np.zeros(3, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int(v)]) for v in s], names=["a", "b", "c"])

    row = met.where("kind = 2").select("counts").mapInArrow(stats, "a long, b long, c long").agg(F.sum("a"), F.sum("b"), F.sum("c")).first()
    words, distinct, ends = (int(x or 0) for x in row)
    tokens = words + ends

    def sorted_out(batches):
        """Of the words that are no symbols: tokens and distinct words; the words seen once and twice, and those that are symbols."""
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([int(v)]) for v in np.frombuffer(counts, np.int64)], names=list("abcde"))

    row = met.where("kind = 1").select("counts").mapInArrow(sorted_out, "a long, b long, c long, d long, e long").agg(*[F.sum(c) for c in "abcde"]).first()
    other_n, other_v, once, twice, symbols = (int(x or 0) for x in row)
    corpus = Corpus(tokens, distinct + int(ends > 0), ends, other_n, other_v, once / (once + 2 * twice) if once and twice else 0.5, symbols)

    def told(function, schema, *answers):
        back = reduce(DataFrame.unionAll, [x.where(F.col("part") >= 0).select("kind", "bucket", "part", "counts") for x in answers])
        return texts.groupBy("part").cogroup(back.groupBy("part")).applyInArrow(function, schema)

    answers = [met.where(F.col("kind") == WORDS)]
    for kind, what in ((TWOS, "twos"), (LONGER, "longer")):
        asked = told(_asking(what, corpus, buckets), SENT, *answers)
        answers.append(cut(asked.groupBy("bucket").applyInArrow(_answered(kind), SENT)))
    weighed = cut(told(_weighing(corpus, buckets), SENT, *answers).groupBy("bucket").applyInArrow(_weighed, SENT))
    held = weighed.where("kind = 0")
    for i in range(DEPTH - 1):
        up = held.select("keys", "counts").mapInArrow(_lifting(buckets), SENT)
        before, held = held, cut(held.groupBy("bucket").cogroup(up.groupBy("bucket")).applyInArrow(_lifted, SENT))
        if i:
            drop(before)
    answers.append(cut(weighed.where("kind = 1").groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(_judged, SENT)))
    drop(weighed)
    drop(held)
    out = told(_scored(corpus, buckets, id_col), f"`{id_col}` {of_id}, train boolean, n_tokens long, n_known long, base_score double, score double", *answers)
    return out.withColumn("train_tokens", F.lit(tokens).cast("long"))


def op6_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0, F.lit(True))
    out = suffix_tree_scores(docs, train)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
