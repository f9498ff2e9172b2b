"""N-best segmentation into the pieces of a public vocabulary, and exact decoding.

A text becomes characters with a mark for each blank and one before the text. No piece has a mark after another character, so
the lattice of a text falls apart before every mark that follows another character; each part ("word") has its own lattice
over the pieces' scores, with byte pieces for characters that have none. Forward Viterbi scores give, for each position,
the best score of any way there; they are an exact heuristic for the A-star search that runs backward from the end, which
therefore pops complete segmentations in order of score. The N best of a whole text combine the words' lists by the same
search over how much each word gives up: only the N - 1 words of least losses can matter, so only they are searched for all
N. The best segmentation of every word, and what the second best loses, come from the Viterbi scores themselves, of all
distinct words of a batch at once: the best way through an arc is worth what leads to it, the arc, and what follows.

Scores are those of the vocabulary file. The public one was made by merging, so its scores are ranks of merges, not
logarithms of probabilities; sums of them order segmentations all the same.

Cases: a null text has no segmentation (zero pieces, null scores); an empty text has its single mark; ties are broken by the
pieces' ids; a literal mark character is spelt in bytes, so decoding gives the text back exactly. Texts of any length are cut
into words in one pass; a word's lattice is linear in its length. Empty tables give empty results; rows that repeat get a row each.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from matchwright.llm.common import MB, packed, sliced

MARK = "▁"
#: A character without a piece costs this much below the lowest score for each of its bytes.
UNKNOWN = 10.0
#: Longer words are searched one by one, since the lattices of a batch are gone through character by character.
LONG_WORD = 64
#: Arcs whose lattices are gone through together, at most: as many as the longest piece has characters begin at each character.
ARCS = 1 << 22


class Pieces:
    """The vocabulary as a dictionary: piece -> (id, score); byte pieces apart."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.ids: dict[str, tuple[int, float]] = {}
        self.bytes: list[int] = [0] * 256
        for k in range(sp.get_piece_size()):
            if sp.is_byte(k):
                self.bytes[int(sp.id_to_piece(k)[1:-1], 16)] = k
            elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
                self.ids[sp.id_to_piece(k)] = (k, float(sp.get_score(k)))
        self.names = {k: p for p, (k, _) in self.ids.items()}
        self.from_byte = {k: b for b, k in enumerate(self.bytes)}
        self.longest = max(map(len, self.ids))
        self.lowest = min(s for _, s in self.ids.values())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a mark after another character")
        #: every prefix of a piece; None where it is no piece itself
        self.known: dict[str, tuple[int, float] | None] = {p[:k]: None for p in self.ids for k in range(1, len(p))} | self.ids
        self.trie = Trie(self)


class Trie:
    """The prefixes as nodes, and the steps between them as one sorted array: key = node << 21 | character."""

    def __init__(self, pieces: Pieces) -> None:
        number = {p: k for k, p in enumerate(sorted(pieces.known), 1)} | {"": 0}
        self.piece, self.score = np.full(len(number), -1, np.int64), np.zeros(len(number))
        for p, (k, score) in pieces.ids.items():
            self.piece[number[p]], self.score[number[p]] = k, score
        steps = sorted((number[p[:-1]] << 21 | ord(p[-1]), k) for p, k in number.items() if p)
        self.keys, self.nodes = np.array([k for k, _ in steps], np.int64), np.array([k for _, k in steps], np.int64)
        self.root = np.full(0x110000, -1, np.int64)  # the steps from the empty prefix, by character
        begins = self.keys < 1 << 21
        self.root[self.keys[begins]] = self.nodes[begins]

    def step(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The next node, or -1."""
        key = node << 21 | character
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], -1)


def words_in(text: str) -> list[str]:
    """The parts of a text; a literal mark is written as a null character and a real one as the mark."""
    marked = MARK + text.replace("\0", "\0\0").replace(MARK, "\0\1").replace(" ", MARK)
    out, start = [], 0
    at = marked.find(MARK, 1)
    while at > 0:
        if marked[at - 1] != MARK:
            out.append(marked[start:at])
            start = at
        at = marked.find(MARK, at + 1)
    out.append(marked[start:])
    return out


def n_best(word: str, pieces: Pieces, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best segmentations of a word, best first, as (score, ids)."""
    size = len(word)
    arcs: list[list[tuple[float, int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]  # by end: (best through it, start, score, ids)
    known, longest, never = pieces.known, pieces.longest, -np.inf
    best = [never] * (size + 1)
    best[0] = 0.0
    for i in range(size):
        here = best[i]
        if here == never:
            continue
        if word[i] == "\0":  # an escaped null character or mark, in bytes
            raw, j = b"\0" if word[i + 1] == "\0" else MARK.encode(), i + 2
        else:
            for j in range(i + 1, min(size, i + longest) + 1):
                hit = known.get(word[i:j], 0)
                if hit == 0:
                    break
                if hit is not None:
                    through = here + hit[1]
                    arcs[j].append((through, i, hit[1], (hit[0],)))
                    if through > best[j]:
                        best[j] = through
            if word[i] in pieces.ids:
                continue
            raw, j = word[i].encode(), i + 1
        score = (pieces.lowest - UNKNOWN) * len(raw)
        arcs[j].append((here + score, i, score, tuple(pieces.bytes[b] for b in raw)))
        if here + score > best[j]:
            best[j] = here + score
    # backward: an entry is a way from the end to `at` and the rank of its next arc; after it, the best arcs lead on to the
    # start at no loss, and every arc passed over on the way is an entry of its own
    for x in arcs:
        if len(x) > 1:
            x.sort(reverse=True)
    found: list[tuple[float, tuple[int, ...]]] = []
    count = 0
    heap = [(-best[size], 0, size, 0, 0.0, None)]
    while heap and len(found) < n:
        _, _, at, k, done, tail = heapq.heappop(heap)
        while at:
            mine = arcs[at]
            if k + 1 < len(mine):
                count += 1
                heapq.heappush(heap, (-(mine[k + 1][0] + done), count, at, k + 1, done, tail))
            _, at, score, out = mine[k]
            done, tail, k = done + score, (out, tail), 0
        ids: list[int] = []
        while tail is not None:
            ids.extend(tail[0])
            tail = tail[1]
        found.append((done, tuple(ids)))
    return found


def combined(lists: list[list[float]], n: int) -> list[tuple[float, dict[int, int]]]:
    """The n best choices of one entry from each list, as (loss, {list: entry}), entries in order of loss and list."""
    order = sorted((x[0] - x[1], k) for k, x in enumerate(lists) if len(x) > 1)[: n - 1]
    heap: list[tuple[float, list[tuple[int, int]], int]] = [(0.0, [], 0)]
    out = []
    while heap and len(out) < n:
        loss, chosen, at = heapq.heappop(heap)
        out.append((loss, dict(chosen)))
        if chosen:  # the last list gives up more
            k, e = chosen[-1]
            if e + 1 < len(lists[k]):
                heapq.heappush(heap, (loss + lists[k][e] - lists[k][e + 1], [*chosen[:-1], (k, e + 1)], at))
        for nxt in range(at, len(order)):
            k = order[nxt][1]
            heapq.heappush(heap, (loss + order[nxt][0], [*chosen, (k, 1)], nxt + 1))
    return out


def encode(text: str, pieces: Pieces, n: int, cache: dict[str, list] | None = None) -> list[tuple[float, list[int]]]:
    """The n best segmentations of one text, best first; segmented() does the same for a table."""
    cache = {} if cache is None else cache
    lists = []
    for w in words_in(text):
        got = cache.get(w)
        if got is None:
            got = cache[w] = n_best(w, pieces, n)
        lists.append(got)
    top = sum(x[0][0] for x in lists)
    out = []
    for loss, other in combined([[s for s, _ in x] for x in lists], n):
        out.append((top - loss, [i for k, x in enumerate(lists) for i in x[other.get(k, 0)][1]]))
    return out


def decode(ids: list[int], pieces: Pieces) -> str:
    """The text of any segmentation."""
    out = b"".join(bytes([pieces.from_byte[i]]) if i in pieces.from_byte else pieces.names[i].replace(MARK, " ").encode() for i in ids)
    return out.decode()[1:]


class Lattices:
    """The piece lattices of many words at once: forward and backward Viterbi scores of every place, arc by arc.

    `characters` holds all words in a row, `begin` where each starts (and where the last ends); no word is empty, none has an
    escape. Afterwards, by word: `score` of its best segmentation, `loss` of the second (the best way through an arc that the
    best one does not take; infinite if there is none), the number of ids (`sizes`), and all ids in a row (`ids`).
    """

    def __init__(self, characters: np.ndarray, begin: np.ndarray, pieces: Pieces) -> None:
        n_words = len(begin) - 1
        length = np.diff(begin)
        word = np.repeat(np.arange(n_words), length)
        start, stop, piece, score = self._arcs(characters, begin, word, pieces)
        word = word[start]
        start, stop = start + word, stop + word  # places: one more than characters in each word
        base = begin[:-1] + np.arange(n_words)
        last = base + length
        self.forward, arc = np.full(int(begin[-1]) + n_words, -np.inf), np.zeros(int(begin[-1]) + n_words, np.int64)
        self.forward[base] = 0.0
        backward = np.full(len(self.forward), -np.inf)
        backward[last] = 0.0
        for at, head, group in self._layers(stop - base[word], stop, stop - start):
            through = self.forward[start[at]] + score[at]
            best = np.maximum.reduceat(through, group)
            self.forward[stop[head]] = best
            hit = np.where(through == np.repeat(best, np.diff(np.append(group, len(at)))), np.arange(len(at)), -1)
            arc[stop[head]] = at[np.maximum.reduceat(hit, group)]  # of equal ways the one with the shortest last piece
        for at, head, group in self._layers(last[word] - start, start, stop - start):
            backward[start[head]] = np.maximum.reduceat(score[at] + backward[stop[at]], group)
        taken, here, first = np.zeros(len(start), bool), last, np.zeros(len(self.forward), bool)
        first[base] = True
        while len(here):
            taken[arc[here]] = True
            here = start[arc[here]]
            here = here[~first[here]]
        self.score = self.forward[last]
        other = np.full(n_words, -np.inf)
        off = np.flatnonzero(~taken)
        np.maximum.at(other, word[off], self.forward[start[off]] + score[off] + backward[stop[off]])
        self.loss = self.score - other
        way = np.flatnonzero(taken)
        way = way[np.argsort(start[way])]
        self.ids, each = self._spelt(piece[way], pieces)
        self.sizes = np.bincount(word[way], weights=each, minlength=n_words).astype(np.int64)

    @staticmethod
    def _arcs(characters: np.ndarray, begin: np.ndarray, word: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, ...]:
        """(start, stop, piece, score); of a character without a piece the piece is -1 - its code."""
        trie, found = pieces.trie, []
        at, node, k = np.arange(len(characters)), trie.root[characters], 0
        ends = begin[1:][word]
        while len(at):
            node = trie.step(node, characters[at + k]) if k else node
            k += 1
            there = node >= 0
            hit = np.flatnonzero(there & (trie.piece[node] >= 0))
            found.append((at[hit], at[hit] + k, trie.piece[node[hit]], trie.score[node[hit]]))
            if k == 1:
                bare = np.setdiff1d(at, at[hit], assume_unique=True)
                code = characters[bare]
                size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                found.append((bare, bare + 1, -1 - code, (pieces.lowest - UNKNOWN) * size))
            go = np.flatnonzero(there & (at + k < ends[at]))
            at, node = at[go], node[go]
        return tuple(np.concatenate(x) for x in zip(*found))

    @staticmethod
    def _layers(layer: np.ndarray, place: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Arcs layer by layer: (arcs by place, long ones first, one arc of each place, where the places begin)."""
        # layer, place, length and the arc itself in one number of 63 bits: 7, 26, 7 and 23
        packed_key = (layer << 56) | (place << 30) | ((LONG_WORD - length) << 23) | np.arange(len(layer))
        packed_key.sort()
        order = packed_key & ((1 << 23) - 1)
        layer, place = layer[order], place[order]
        edges = np.append(np.searchsorted(layer, np.arange(int(layer[-1]) + 1)), len(order)).tolist()
        fresh = np.append(True, place[1:] != place[:-1])
        for a, b in zip(edges, edges[1:]):
            if b > a:
                fresh[a] = True
                group = np.flatnonzero(fresh[a:b])
                at = order[a:b]
                yield at, at[group], group

    @staticmethod
    def _spelt(piece: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many for each piece): characters without a piece become byte pieces."""
        each = np.ones(len(piece), np.int64)
        bare = np.flatnonzero(piece < 0)
        if not len(bare):
            return piece.astype(np.uint32), each
        codes, which = np.unique(-1 - piece[bare], return_inverse=True)
        spelt = [[pieces.bytes[b] for b in chr(c).encode()] for c in codes.tolist()]
        sizes = np.array([len(x) for x in spelt])
        each[bare] = sizes[which]
        ends = np.cumsum(each)
        out = np.repeat(piece, each)
        pool, first = np.array([i for x in spelt for i in x]), np.append(0, np.cumsum(sizes))[:-1]
        n = sizes[which]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat((ends - each)[bare], n) + step] = pool[np.repeat(first[which], n) + step]
        return out.astype(np.uint32), each


class Cache:
    """Segmentations of the distinct words of a batch: of each the best and the loss of the second, all n where a text needs them."""

    def __init__(self, pieces: Pieces, n: int, most: int) -> None:
        self.pieces, self.n, self.most = pieces, n, most
        self.lists: dict[bytes, list[tuple[float, tuple[int, ...]]]] = {}

    def _search(self, word: bytes, n: int) -> list[tuple[float, tuple[int, ...]]]:
        return n_best(word.decode().replace("\0", "\0\0").replace(MARK, "\0\1").replace(" ", MARK), self.pieces, n)

    def best(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(scores, losses, sizes, where the ids of each begin, ids). Very long words and those with escapes are searched one by one."""
        raw, offsets = packed_bytes(words)
        heads = (raw & 0xC0) != 0x80
        count = np.append(0, np.cumsum(heads))
        begin = count[offsets]
        text = raw.tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        odd = (codes == 0) | (codes == ord(MARK))
        alone = (np.diff(begin) > LONG_WORD) | (np.add.reduceat(odd, begin[:-1]) > 0)
        codes[codes == 32] = ord(MARK)
        n = len(words)
        score, loss, sizes = np.zeros(n), np.full(n, np.inf), np.zeros(n, np.int64)
        plain = np.flatnonzero(~alone)
        pools = []
        size = np.diff(begin)
        runs = np.flatnonzero(np.append(True, np.diff(np.cumsum(size[plain]) // (ARCS // self.pieces.longest)) > 0)).tolist() if len(plain) else []
        for i, j in zip(runs, [*runs[1:], len(plain)]):
            mine = plain[i:j]
            ends = np.cumsum(size[mine])
            places = np.repeat(begin[mine] - (ends - size[mine]), size[mine]) + np.arange(int(ends[-1]))
            x = Lattices(codes[places], np.append(0, ends), self.pieces)
            score[mine], loss[mine], sizes[mine] = x.score, x.loss, x.sizes
            pools.append(x.ids)
        for k in np.flatnonzero(alone).tolist():
            found = self._search(words[k].as_py(), min(2, self.n))
            score[k], sizes[k] = found[0][0], len(found[0][1])
            loss[k] = found[0][0] - found[1][0] if len(found) > 1 else np.inf
            pools.append(np.array(found[0][1], np.uint32))
        order = np.append(plain, np.flatnonzero(alone))
        first = np.zeros(n, np.int64)
        first[order] = np.append(0, np.cumsum(sizes[order]))[:-1]
        return score, loss, sizes, first, np.concatenate(pools)

    def all(self, word: bytes) -> list[tuple[float, tuple[int, ...]]]:
        got = self.lists.get(word)
        if got is None:
            if len(self.lists) >= self.most:
                self.lists.clear()
            got = self.lists[word] = self._search(word, self.n)
        return got


def packed_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _batch(raw: np.ndarray, offsets: np.ndarray, cache: Cache) -> Iterator[tuple[list[float], list[np.ndarray]]]:
    """For each text its n best (scores, ids): distinct words are segmented once."""
    n_docs, n = len(offsets) - 1, cache.n
    marked = np.insert(raw, offsets[:-1], np.uint8(32))
    offsets = offsets + np.arange(n_docs + 1)
    blank = marked == 32
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[offsets[:-1]] = True
    bounds = np.append(np.flatnonzero(start), len(marked))
    units = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(marked.tobytes())]).dictionary_encode()
    index = units.indices.to_numpy()
    words = units.dictionary
    score, loss, sizes, first, pool = cache.best(words)
    score, loss = score[index], loss[index]
    n_ids = sizes[index]
    ends = np.append(0, np.cumsum(n_ids))
    flat = pool[np.repeat(first[index] - ends[:-1], n_ids) + np.arange(int(ends[-1]))]
    at = np.searchsorted(bounds[:-1], offsets)
    at[-1] = len(index)
    doc = np.repeat(np.arange(n_docs), np.diff(at))
    top = np.add.reduceat(score, at[:-1])
    order = np.lexsort((loss, doc))
    for d in range(n_docs):
        a, b = int(at[d]), int(at[d + 1])
        few = [int(k) for k in order[a : min(b, a + n - 1)] if loss[k] < np.inf]
        ids = flat[ends[a] : ends[b]]
        scores, ways = [], []
        lists = [cache.all(words[int(index[k])].as_py()) for k in few]
        for lost, other in combined([[x for x, _ in y] for y in lists], n):
            scores.append(float(top[d]) - lost)
            parts, done = [], a
            for k, ids_k in sorted((few[k], lists[k][e][1]) for k, e in other.items()):
                parts += [flat[ends[done] : ends[k]], np.array(ids_k, np.uint32)]
                done = k + 1
            ways.append(np.concatenate([*parts, flat[ends[done] : ends[b]]]) if parts else ids)
        yield scores, ways


def segmented(docs: DataFrame, model: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", words_kept: int = 250_000) -> DataFrame:
    """id, ids array (best), score, scores array (n best), crcs array (of each of the n best, unsigned 32-bit ids), decodes boolean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = None
        for batch in sliced(batches, text_col, 4 * MB):
            cache = cache or Cache(Pieces(model), n, words_kept)
            column = batch.column(text_col)
            raw, offsets = packed(column)
            whole, null = raw.tobytes(), column.is_null().to_pylist()
            rows: list[list] = [[] for _ in range(5)]
            spelt = [b.replace(MARK.encode(), b" ") for b in ((cache.pieces.names.get(i) or "").encode() for i in range(max(cache.pieces.names) + 1))]
            for i, byte in cache.pieces.from_byte.items():
                spelt[i] = bytes([byte])
            for k, (scores, ways) in enumerate(_batch(raw, offsets, cache)):
                if null[k]:
                    values = ([], None, [], [], None)
                else:
                    text = b"".join([spelt[i] for i in ways[0].tolist()])[1:]
                    values = (ways[0].astype(np.int32), scores[0], scores, [zlib.crc32(w.tobytes()) for w in ways], text == whole[offsets[k] : offsets[k + 1]])
                for r, v in zip(rows, values):
                    r.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(rows[0], pa.list_(pa.int32())), pa.array(rows[1], pa.float64()), pa.array(rows[2], pa.list_(pa.float64())), pa.array(rows[3], pa.list_(pa.int64())), pa.array(rows[4], pa.bool_())],
                names=[id_col, "ids", "score", "scores", "crcs", "decodes"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, score double, scores array<double>, crcs array<long>, decodes boolean")


def public_model(path: str | None = None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("piece_bpe_32k.model")


def op8_nbest_segmentation(spark: SparkSession, sf_dir: str, n: int = 4) -> DataFrame:
    from pyspark.sql import functions as F

    out = segmented(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_model(), n)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", "scores", "crcs", "decodes")
