"""External induced sorting of suffixes with common-prefix values.

A text over integer symbols is sorted in the induced way: suffixes are of type S or L, the substrings between leftmost S
suffixes get names in their order, the string of names is sorted by recursion (or directly once it fits `base` symbols),
and two scans then induce the L suffixes upward and the S suffixes downward. Each scan takes tuples (symbol, rank of the
following suffix, suffix) from a priority queue whose sorted runs go to disk beyond `limit` tuples, so a shard needs
memory for its text and order only. Since all tuples of one symbol leave the queue together and in rank order, a scan works on
arrays. The common-prefix length of neighbours is carried along: one more than the least value between the ranks that
induced them, and where an L and an S suffix of one symbol meet, the shorter of their runs of that symbol.
"""

from __future__ import annotations

import heapq
import os

import numpy as np


class DiskQueue:
    """A priority queue of (symbol, rank, suffix); pop() takes all tuples of the least symbol in order of rank."""

    def __init__(self, folder: str, limit: int, sign: int = 1) -> None:
        self.folder, self.limit, self.sign = folder, limit, sign
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.count, self.made = 0, 0
        self.heap: list[int] = []
        self.queued: set[int] = set()
        self.runs: list[tuple[str, dict[int, tuple[int, int]]]] = []

    def push(self, symbol: np.ndarray, rank: np.ndarray, suffix: np.ndarray) -> None:
        if not len(symbol):
            return
        order = np.argsort(symbol, kind="stable")
        symbol, rank, suffix = symbol[order], rank[order], suffix[order]
        bounds = np.flatnonzero(np.diff(symbol)) + 1
        starts = [0, *bounds.tolist()]
        for a, b in zip(starts, [*starts[1:], len(symbol)]):
            c = int(symbol[a])
            self.held.setdefault(c, []).append((rank[a:b], suffix[a:b]))
            if c not in self.queued:
                self.queued.add(c)
                heapq.heappush(self.heap, self.sign * c)
        self.count += len(symbol)
        if self.count > self.limit:
            self._spill()

    def _spill(self) -> None:
        """The tuples held go to disk as one run, by symbol and rank."""
        name = os.path.join(self.folder, f"run-{id(self)}-{self.made}")
        self.made += 1
        index: dict[int, tuple[int, int]] = {}
        with open(name, "wb") as f:
            for c in sorted(self.held):
                r, s = self._joined(self.held[c])
                index[c] = (f.tell(), len(r))
                f.write(r.astype(np.int64).tobytes() + s.astype(np.int64).tobytes())
        self.held, self.count = {}, 0
        self.runs.append((name, index))

    @staticmethod
    def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def least(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def pop(self) -> tuple[np.ndarray, np.ndarray]:
        c = self.sign * heapq.heappop(self.heap)
        self.queued.discard(c)
        parts = []
        for name, index in self.runs:
            if (at := index.pop(c, None)) is not None:
                with open(name, "rb") as f:
                    f.seek(at[0])
                    both = np.frombuffer(f.read(16 * at[1]), dtype=np.int64)
                parts.append((both[: at[1]], both[at[1] :]))
        for name, index in [x for x in self.runs if not x[1]]:
            os.unlink(name)
        self.runs = [x for x in self.runs if x[1]]
        mine = self.held.pop(c, [])
        self.count -= sum(len(p[0]) for p in mine)
        rank, suffix = self._joined(parts + mine)
        if len(rank) > 1 and (rank[1:] < rank[:-1]).any():
            order = np.argsort(rank, kind="stable")
            rank, suffix = rank[order], suffix[order]
        return rank, suffix


class _Words:
    """Eight symbols of a byte text at any position as one integer, the first symbol highest."""

    def __init__(self, t: np.ndarray) -> None:
        padded = np.zeros(len(t) + 8, np.uint64)
        padded[: len(t)] = t
        w = padded[: len(t)].copy()
        for k in range(1, 8):
            w = (w << np.uint64(8)) | padded[k : len(t) + k]
        self.w, self.n = w, len(t)

    def at(self, pos: np.ndarray) -> np.ndarray:
        return self.w[np.minimum(pos, self.n - 1)]


def _names(t: np.ndarray, words: _Words | None, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Ranks of the substrings; where one is a prefix of another, the longer one is less (its next symbol is of type L)."""
    rank = np.zeros(len(start), np.int64)
    active, offset, step = np.arange(len(start)), 0, 8 if words is not None else 1
    while len(active):
        left = length[active] - offset
        if words is not None:
            key = words.at(start[active] + offset)
            short = np.clip(8 - left, 0, 8)
            fill = np.where(short >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (np.minimum(short, 7) * 8).astype(np.uint64)) - np.uint64(1))
            key = key | fill
        else:
            key = np.where(left > 0, t[np.minimum(start[active] + offset, len(t) - 1)], np.iinfo(np.int64).max)
        order = np.lexsort((key, rank[active]))
        a, k = active[order], key[order]
        r, i = rank[a], np.arange(len(a))
        group = np.ones(len(a), bool)
        group[1:] = r[1:] != r[:-1]
        sub = group.copy()
        sub[1:] |= k[1:] != k[:-1]
        first = np.maximum.accumulate(np.where(sub, i, 0))
        rank[a] = r + first - np.maximum.accumulate(np.where(group, i, 0))
        many = np.diff(np.append(np.flatnonzero(sub), len(a)))
        again = np.repeat(many, many) > 1
        again &= length[a] > offset + step
        # all of a subgroup end together or go on together: the filler differs from every symbol
        active = a[again]
        offset += step
    return np.unique(rank, return_inverse=True)[1].astype(np.int64)


def _doubled(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a short string, by doubling ranks."""
    n, rank, k = len(names), names.astype(np.int64), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


def _common(words: _Words, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common-prefix lengths of pairs of suffixes, up to depth."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for offset in range(0, depth, 8):
        if not len(live):
            break
        x = words.at(a[live] + offset) ^ words.at(b[live] + offset)
        same = np.zeros(len(live), np.int64)
        for k in range(8):  # leading bytes that agree
            same += (x >> np.uint64(56 - 8 * k)) == 0
        out[live] = offset + same
        live = live[x == 0]
    return np.minimum(out, depth)


def _carried(lcp: np.ndarray, before: int, rank: np.ndarray, depth: int) -> np.ndarray:
    """One more than the least value over (previous rank, rank], for ranks in order."""
    starts = np.empty(len(rank), np.int64)
    starts[0], starts[1:] = before, rank[:-1]
    starts += 1
    low = starts[0]
    return np.minimum(np.minimum.reduceat(lcp[low : rank[-1] + 1], starts - low) + 1, depth)


def sorted_suffixes(t: np.ndarray, depth: int, folder: str, limit: int = 4_000_000, base: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common-prefix length with the one before, up to depth); depth 0 leaves the lengths out.

    The last symbol must be less than all others; an uint8 text must not hold the value 255.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    words = _Words(t) if t.dtype == np.uint8 else None
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    sizes = np.diff(np.append(-1, ends))
    rising = np.ones(len(ends), bool)
    rising[:-1] = t[ends[:-1]] < t[ends[:-1] + 1]
    is_s = np.repeat(rising, sizes)
    run = np.repeat(ends, sizes) - np.arange(n) + 1
    star = is_s.copy()
    star[0] = False
    star[1:] &= ~is_s[:-1]
    stars = np.flatnonzero(star)
    lengths = np.append(np.diff(stars) + 1, 1)
    names = _names(t, words, stars, lengths)
    if names.max() == len(names) - 1:
        order = np.argsort(names)
    elif len(names) <= base:
        order = _doubled(names)
    else:
        order = sorted_suffixes(names, 0, folder, limit, base)[0]
    stars = stars[order]
    with_lcp = depth > 0
    star_lcp = np.zeros(len(stars), np.int64)
    if with_lcp and len(stars) > 1:
        star_lcp[1:] = _common(words, stars[:-1], stars[1:], depth)

    # upward: L suffixes, from the sorted stars
    symbols = t[stars].astype(np.int64)
    total = int((~is_s).sum()) + len(stars)
    pos, lcp = np.zeros(total, np.int64), np.zeros(total, np.int64)
    queue, at, star_at = DiskQueue(folder, limit), 0, 0

    def take(suffixes: np.ndarray, values: np.ndarray | None, want_s: bool, q: DiskQueue) -> None:
        nonlocal at
        m = len(suffixes)
        pos[at : at + m] = suffixes
        if values is not None:
            lcp[at : at + m] = values
        before = suffixes - 1
        ok = (suffixes > 0) & (is_s[before] == want_s)
        before = before[ok]
        q.push(t[before].astype(np.int64), np.arange(at, at + m)[ok], before)
        at += m

    def scan(q: DiskQueue, c: int, want_s: bool) -> bool:
        """All suffixes that have been or will be induced for symbol c."""
        last = None
        while q.least() == c:
            rank, suffix = q.pop()
            values = None
            if with_lcp:
                values = np.zeros(len(rank), np.int64)
                if last is not None:
                    values[:] = _carried(lcp, last, rank, depth)
                elif len(rank) > 1:
                    values[1:] = _carried(lcp, int(rank[0]), rank[1:], depth)
                last = int(rank[-1])
            else:
                last = 0
            take(suffix, values, want_s, q)
        return last is not None

    while star_at < len(stars) or queue.least() is not None:
        c = min(x for x in (queue.least(), int(symbols[star_at]) if star_at < len(stars) else None) if x is not None)
        some = scan(queue, c, False)
        stop = int(np.searchsorted(symbols, c, side="right"))
        if stop > star_at:
            values = star_lcp[star_at:stop].copy()
            values[0] = min(run[pos[at - 1]], run[stars[star_at]], depth) if some else 0
            take(stars[star_at:stop], values, False, queue)
            star_at = stop
    kept = ~is_s[pos]
    l_pos, l_lcp = pos[kept], lcp[kept]
    l_symbols = t[l_pos].astype(np.int64)

    # downward: S suffixes, from the L suffixes just sorted
    pos, lcp, at = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    queue, l_at = DiskQueue(folder, limit, -1), len(l_pos)
    while l_at > 0 or queue.least() is not None:
        c = max(x for x in (queue.least(), int(l_symbols[l_at - 1]) if l_at else None) if x is not None)
        some = scan(queue, c, True)
        start = int(np.searchsorted(l_symbols, c, side="left"))
        if start < l_at:
            down = l_pos[start:l_at][::-1]
            values = np.zeros(len(down), np.int64)
            values[1:] = l_lcp[start + 1 : l_at][::-1]
            values[0] = min(run[pos[at - 1]], run[down[0]], depth) if some else 0
            take(down, values, True, queue)
            l_at = start
    pos[at] = n - 1
    out = np.zeros(n, np.int64)
    out[1:] = lcp[::-1][:-1]
    return pos[::-1], out
