"""Personal data by candidate gradient boosting: spans of e-mail addresses, IP addresses, card and phone numbers.

Four fixed patterns with their checks give the base spans, which always stay. Generators of high recall propose further
spans, which may overlap: windows of digit groups with any separators (a card in a longer chain of digits, a phone without a
country code), defanged addresses, and written-out ones (`name [at] host dot com`). Boosted trees score each from its format
(digits, groups, separators, checksum, labels) and its context (neighbours, words before it). Scores are calibrated on
examples that the trees did not see, and a kind's threshold is the least score whose calibrated probability is `SURE`. Of the
candidates above it that meet no base span the likeliest are taken first, and those that overlap one taken are dropped.

There are no labels of personal data, so the examples label themselves: base spans are true, and so are their views (the same
datum, or another of its kind, written in another way in the same context); candidates that meet no base span are false, and so are base spans spoilt
(a wrong checksum, parts out of range, digits inside a token). They come from all documents. Equal ones are one row with a count;
bins, trees, calibration and thresholds are made of such counts alone. The sums that a tree grows by come from the
driver where there are at most `AT_ONCE` binned rows, else from a Spark job for each level.

Cases: null and empty texts have no spans. Offsets count code points, ends are exclusive. Repeated rows get a row each, null
ids are carried. Without enough examples of a kind nothing is added to its base spans. Texts are scanned whole, in linear
time: no pattern can be retried from within a run that it failed on. Empty tables give empty results.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchwright.llm import boosted_trees
from matchwright.llm.common import MB, cut, free, pieces, release, sliced, table

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Binned rows that the driver takes; more stay on the executors, PART of them in a task.
AT_ONCE, PART = 60_000, 250_000
SURE, LEAST = 0.95, 20
BEFORE, AFTER = 40, 20

Span = tuple[int, int, int]  # start, kind, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

MARK = re.compile(r"@|[\[({] ?at ?[\])}]", re.I)
WRITTEN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot )[A-Za-z0-9-]{1,63})+", re.I)
ZONE = re.compile(r"[0-9](?:[ .()/-]{0,3}[0-9])++")
GROUP = re.compile(r"[0-9]+")
DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?: ?[\[({] ?(?:\.|dot) ?[\])}] ?| \. | dot )[0-9]{1,3}){3}(?![0-9])", re.I)
WINDOW = 8  # groups of digits in a candidate

#: Words that speak for each kind, and words that speak against all.
SPEAKS = (
    ("mail", "contact", "write", "address", "reach"),
    ("ip", "host", "server", "address", "from", "ping"),
    ("card", "visa", "credit", "pay", "debit"),
    ("phone", "tel", "call", "mobile", "fax", "dial"),
)
AGAINST = ("token", "key", "hash", "version", "isbn", "order", "serial", "ref", "id=")
ENDINGS = frozenset("com org net edu gov info biz io co uk de fr es it eu us example test".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind."""
    found: list[Span] = []
    at, free_from = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free_from and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            found.append((start, EMAIL, host.end()))
            free_from = host.end()
        at = text.find("@", at + 1)
    for m in QUAD.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            found.append((m.start(), IP, m.end()))
    for m in CHAIN.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in CALL.finditer(text):
            if 9 <= len(NO_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def candidates(text: str) -> list[Span]:
    """Spans that the generators propose, whether they meet base spans or each other."""
    found: set[Span] = set()
    marks = [m.span() for m in MARK.finditer(text)]
    at = text.find(" dot ")
    while at >= 0:  # `name at host dot com`
        j = text.rfind(" at ", max(0, at - 140), at)
        if j >= 0:
            marks.append((j, j + 4))
        at = text.find(" dot ", at + 1)
    for a, b in marks:
        a -= a > 0 and text[a - 1] == " " and text[a] != " "
        b += b < len(text) and text[b] == " " and text[b - 1] != " "
        start = a
        while start > 0 and a - start < 64 and text[start - 1] in LOCAL:
            start -= 1
        host = WRITTEN.match(text, b) if start < a else None
        if host:
            found.add((start, EMAIL, host.end()))
    if "." in text or "dot" in text:
        found.update((m.start(), IP, m.end()) for m in DEFANGED.finditer(text))
    for zone in ZONE.finditer(text):
        if zone.end() - zone.start() < 9:
            continue
        groups = [m.span() for m in GROUP.finditer(text, *zone.span())]
        for i, (start, _) in enumerate(groups):
            n = 0
            for a, b in groups[i : i + WINDOW]:
                n += b - a
                if n > 19:
                    break
                if n >= 12:
                    found.add((start, CARD, b))
                if 9 <= n <= 15:
                    first = start - (start > 0 and text[start - 1] == "(")
                    first -= first > 0 and text[first - 1] == "+"
                    found.add((first, PHONE, b))
    return sorted(found)


WIDTH = 30


def features(kind: int, span: str, left: str, right: str) -> list[float]:
    """What the trees see of a candidate: its format and its context."""
    groups = GROUP.findall(span)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    between = [s for s in re.split(r"[0-9]+", span)[1:-1]] if groups else []
    near = left.lower()
    labels = re.split(r"[^A-Za-z0-9-]+", span)
    last = labels[-1].lower() if labels else ""
    edge = lambda c: 0.0 if not c or c.isspace() else 2.0 if c.isalnum() else 1.0
    values = [int(g) if len(g) <= 4 else 9999 for g in groups]
    around = (re.search(r"[A-Za-z0-9]*\Z", left) or [""])[0], (re.match(r"[A-Za-z0-9]*", right) or [""])[0]
    typical = {(4, 4, 4, 4), (4, 6, 5), (16,), (15,)} if kind == CARD else {(3, 3, 4), (1, 3, 3, 4), (2, 3, 3, 4), (3, 3, 3, 4)}
    return [
        *[float(kind == k) for k in range(4)],
        len(digits), len(span), len(groups), max(sizes), min(sizes), len(set(between)), sum(map(len, between)),
        float(12 <= len(digits) <= 19 and luhn(digits)), int(digits[0]) if digits else -1, float(span[:1] == "+"), float(span.startswith("00")),
        span.count("("), float(tuple(sizes) in typical), max(values, default=-1), len(labels), float("@" in span),
        float(last in ENDINGS), float(last.isalpha()), len(last), edge(left[-1:]), edge(right[:1]), len(around[0]) + len(around[1]),
        sum(c.isdigit() for c in left) / BEFORE, sum(c.isdigit() for c in right) / AFTER,
        float(any(w in near for w in SPEAKS[kind])), float(any(w in near for w in AGAINST)),
    ]


def written_anew(kind: int, span: str, rng: random.Random) -> list[str]:
    """The same datum in other forms that the fixed patterns miss."""
    digits = NO_DIGIT.sub("", span)
    if kind == EMAIL:
        local, _, host = span.partition("@")
        at, dot = rng.choice([" at ", " [at] ", "[at]", " (at) ", "(at)"]), rng.choice([" dot ", "[dot]", " [dot] ", "[.]"])
        return [f"{local}{at}{host.replace('.', dot)}", f"{local}{rng.choice(['[at]', ' [at] ', '(at)'])}{host}", f"{local} @ {host}"]
    if kind == IP:
        return [span.replace(".", s) for s in rng.sample(["[.]", "(.)", " . ", " [.] ", "[dot]", " dot "], 3)]
    if kind == CARD:
        cuts = [4, 10] if len(digits) == 15 else range(4, len(digits), 4)
        parts = [digits[a:b] for a, b in zip([0, *cuts], [*cuts, len(digits)])]
        return [s.join(parts) for s in rng.sample([".", "/", " - ", "  ", " . ", " ", "-"], 3)]
    body = digits[-10:]
    forms = [f"({body[:3]}) {body[3:6]}-{body[6:]}", f"{body[:3]}-{body[3:6]}-{body[6:]}", f"{body[:3]}.{body[3:6]}.{body[6:]}", f"00{digits[:-10] or '1'} {body[:3]} {body[3:6]} {body[6:]}"]
    return rng.sample(forms, 3) if len(digits) >= 10 else []


def sibling(kind: int, span: str, rng: random.Random) -> str:
    """Another datum of the kind, in the same form."""
    if kind == EMAIL:
        name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))
        host = re.sub("[0-9]+", "", span.partition("@")[2])
        return f"{name()}{rng.choice(['', '.', '_', '-'])}{name()}@{host if HOST.fullmatch(host) else 'mail.example.com'}"
    if kind == IP:
        return ".".join(str(rng.choice([rng.randint(0, 9), rng.randint(10, 99), rng.randint(100, 255)])) for _ in range(4))
    made = "".join(rng.choice("0123456789") if c.isdigit() and k else c for k, c in enumerate(span))
    if kind == CARD:
        return next(made[:-1] + d for d in "0123456789" if luhn(NO_DIGIT.sub("", made[:-1] + d)))
    return made


def spoilt(kind: int, span: str, rng: random.Random) -> list[tuple[str, str, str]]:
    """(what stands before, span, what stands after) of forms that look alike but are no such datum."""
    digits = NO_DIGIT.sub("", span)
    other = lambda s: s[:-1] + str((int(s[-1]) + rng.randint(1, 9)) % 10)
    token = "".join(rng.choice("abcdef") for _ in range(6))
    if kind == EMAIL:
        local, _, host = span.partition("@")
        words = [w for w in re.split(r"[^A-Za-z]+", host) if w]
        return [(" ", f"{local} at {rng.choice(words or ['noon'])} dot {rng.choice(['then', 'the', 'and', 'a'])}", " "), (" ", f"{local}[at]{rng.randint(0, 9)}.{rng.randint(0, 99)}", " ")]
    if kind == IP:
        parts = span.split(".")
        parts[rng.randrange(4)] = str(rng.randint(256, 999))
        return [(" ", "[.]".join(parts), " "), (" ", " . ".join(parts), " ")]
    if kind == CARD:
        wrong = other(digits)
        four = [wrong[i : i + 4] for i in range(0, len(wrong), 4)]
        return [(" ", wrong, " "), (" ", rng.choice([".", "/", " ", "-"]).join(four), " "), (token, digits, token)]
    wild = "".join(rng.choice("0123456789") for _ in range(rng.randint(9, 15)))
    pairs = rng.choice([" ", ".", "/", "-"]).join(wild[i : i + 2] for i in range(0, len(wild), 2))
    return [(token, digits, token), (" ", wild, " "), (" ", pairs, " ")]


def examples(text: str) -> Iterator[tuple[int, int, list[float]]]:
    """(kind, label, features) of what a text teaches."""
    base = base_spans(text)
    taken = [(s, e) for s, _, e in base]
    for start, kind, end in base:
        span, left, right = text[start:end], text[max(0, start - BEFORE) : start], text[end : end + AFTER]
        rng = random.Random(zlib.crc32(f"{kind}:{span}:{left}".encode()))
        other = sibling(kind, span, rng)
        for form in (span, *written_anew(kind, span, rng), *written_anew(kind, other, rng)):
            yield kind, 1, features(kind, form, left, right)
        for before, form, after in (*spoilt(kind, span, rng), *spoilt(kind, other, rng)):
            yield kind, 0, features(kind, form, (left + before)[-BEFORE:], (after + right)[:AFTER])
    for start, kind, end in apart(candidates(text), taken):
        yield kind, 0, features(kind, text[start:end], text[max(0, start - BEFORE) : start], text[end : end + AFTER])


def apart(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """The spans that meet none of the taken ones; both ascend by start."""
    if not taken or not spans:
        return spans
    starts = np.array([s for s, _ in taken])
    ends = np.maximum.accumulate(np.array([e for _, e in taken]))
    at = np.searchsorted(starts, np.array([e for _, _, e in spans])) - 1  # the last that starts before the span's end
    reach = np.where(at >= 0, ends[at], 0)
    return [s for s, r in zip(spans, reach.tolist()) if r <= s[0]]


@dataclass
class Model:
    """Boosted trees, and for each kind its calibration and the least score that is taken."""

    trees: boosted_trees.Boosted | None = None
    calibrated: list[boosted_trees.Isotonic] = field(default_factory=list)
    bars: list[float] = field(default_factory=lambda: [float("inf")] * 4)

    def added(self, text: str, base: list[Span]) -> list[tuple[int, int, int, float]]:
        """(start, kind, end, probability) of the spans that the model adds: likeliest first, longer first, none overlapping."""
        if self.trees is None:
            return []
        spans = apart(candidates(text), [(s, e) for s, _, e in base])
        spans = [s for s in spans if self.bars[s[1]] < float("inf")]
        if not spans:
            return []
        raw = self.trees.raw(np.array([features(k, text[s:e], text[max(0, s - BEFORE) : s], text[e : e + AFTER]) for s, k, e in spans], np.float32))
        good = [(float(self.calibrated[k](np.array([r]))[0]), -(e - s), s, k, e) for (s, k, e), r in zip(spans, raw.tolist()) if r >= self.bars[k]]
        kept: list[tuple[int, int, int, float]] = []
        used: list[tuple[int, int]] = []
        for p, _, s, k, e in sorted(good, key=lambda g: (-g[0], g[1], g[2], g[3])):
            if _fits(used, s, e):
                kept.append((s, k, e, p))
        return kept


def _fits(used: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether no used range meets this one; if so it is added, in order."""
    at = bisect.bisect_left(used, (start, end))
    if (at < len(used) and used[at][0] < end) or (at and used[at - 1][1] > start):
        return False
    used.insert(at, (start, end))
    return True


def _binned(rows: DataFrame) -> tuple[list[np.ndarray], DataFrame]:
    """Edges of bins of equal counts over the rows not held out, and all rows (kind, label, held, codes, n) by them, equal ones as one."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = _matrix(batch.column("x"), np.float32), batch.column("n").to_numpy()
            for f in range(WIDTH if len(x) else 0):
                v, at = np.unique(x[:, f], return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), f, np.int32)), pa.array(v), pa.array(np.bincount(at, weights=n).astype(np.int64))], names=["f", "v", "n"])

    values = rows.where("not held").mapInArrow(each, "f int, v float, n long").groupBy("f", "v").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("f")
    before = F.sum("n").over(own.orderBy("v")) - F.col("n")
    cuts = values.select("f", "v", F.floor(before * boosted_trees.BINS / F.sum("n").over(own)).alias("bin")).groupBy("f", "bin").agg(F.min("v").alias("v"))
    edges: list[list[float]] = [[] for _ in range(WIDTH)]
    for f, _, v in sorted(cuts.collect()):  # a row for each bin of each feature at most
        edges[f].append(v)
    found = [np.array(e[1:]) for e in edges]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = boosted_trees._codes(_matrix(batch.column("x"), np.float32), found).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("kind", "label", "held", "n")], pa.array([c.tobytes() for c in codes], pa.binary())], names=["kind", "label", "held", "n", "codes"])

    same = rows.mapInArrow(coded, "kind int, label int, held boolean, n long, codes binary")
    return found, cut(same.groupBy("kind", "label", "held", "codes").agg(F.sum("n").alias("n")))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, WIDTH)


def _blobs(rows: DataFrame, n: int) -> DataFrame:
    """Rows of up to a batch each, in an order that does not depend on the tasks before, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = [b"".join(batch.column("codes").to_pylist()), *[batch.column(c).to_numpy().astype(t).tobytes() for c, t in (("kind", np.uint8), ("label", np.uint8), ("n", np.int64))]]
                yield pa.RecordBatch.from_arrays([pa.array([h], pa.binary()) for h in held], names=["codes", "kind", "label", "n"])

    keys = ("codes", "kind", "label")
    return cut(rows.repartition(pieces(n, PART), *keys).sortWithinPartitions(*keys).mapInArrow(run, "codes binary, kind binary, label binary, n binary"))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for k in range(batch.num_rows):
        codes, kind, label, n = (np.frombuffer(batch.column(c)[k].as_py(), t) for c, t in (("codes", np.uint8), ("kind", np.uint8), ("label", np.uint8), ("n", np.int64)))
        yield codes.reshape(-1, WIDTH), kind, label, n


def _apart_sums(rows: DataFrame, n: int, weight: np.ndarray):
    """Sums over rows that stay on the executors: a job for each level, a histogram for each task."""
    blobs = _blobs(rows, n)

    def sums(made: boosted_trees.Boosted, feature: np.ndarray, split: np.ndarray, level: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, 1 << level, WIDTH, boosted_trees.BINS))
            for batch in batches:
                for codes, kind, label, n in _rows(batch):
                    total += boosted_trees.histogram(codes, label, weight[kind, label] * n, made.raw_of(codes), feature, split, level)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        parts = blobs.mapInArrow(run, "sums binary").withColumn("part", F.spark_partition_id()).toArrow().sort_by("part").column("sums")
        return sum(np.frombuffer(p.as_py(), np.float64) for p in parts).reshape(2, 1 << level, WIDTH, -1)

    return sums


def _apart_pools(rows: DataFrame, n: int, trees: boosted_trees.Boosted) -> list[np.ndarray]:
    """Pools of each kind: those of ranges of scores, pooled again."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, n = _matrix(batch.column("codes"), np.uint8), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(trees.raw_of(codes)), pa.array(n * batch.column("label").to_numpy()), pa.array(n)], names=["kind", "raw", "ones", "n"])

    def pools(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            for k in np.unique(kinds):
                got = boosted_trees.pooled(*[batch.column(c).to_numpy()[kinds == k] for c in ("raw", "ones", "n")])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), k, np.int32)), *[pa.array(got[:, i]) for i in range(3)]], names=["kind", "raw", "ones", "n"])

    scores = rows.mapInArrow(told, "kind int, raw double, ones long, n long").groupBy("kind", "raw").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    ranges = scores.repartitionByRange(pieces(n, PART), "kind", "raw").sortWithinPartitions("kind", "raw")
    got = ranges.mapInArrow(pools, "kind int, raw double, ones double, n double").orderBy("kind", "raw").toArrow()
    kind = got.column("kind").to_numpy()
    return [boosted_trees.pooled(*[got.column(c).to_numpy()[kind == k] for c in ("raw", "ones", "n")]) for k in range(4)]


def _pools(kind: np.ndarray, raw: np.ndarray, label: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(raw, kind="stable")
    kind, raw, label, n = kind[order], raw[order], label[order], n[order]
    out = []
    for k in range(4):
        own = kind == k
        score, at = np.unique(raw[own], return_inverse=True)
        out.append(boosted_trees.pooled(score, np.bincount(at, (label * n)[own], len(score)), np.bincount(at, n[own], len(score))))
    return out


def fit(docs: DataFrame, text_col: str = "text", at_once: int = AT_ONCE, rounds: int = 60) -> Model:
    """Trees, calibration and thresholds from the examples of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", MB):
            found = Counter((k, y, np.array(f, np.float32).tobytes()) for t in batch.column("text").to_pylist() if t for k, y, f in examples(t))
            columns = [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.binary()), pa.array(list(found.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "label", "x", "n"])
        release()

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "kind int, label int, x binary, n long").groupBy("kind", "label", "x").agg(F.sum("n").alias("n"))
    # equal examples stay on one side
    edges, cells = _binned(cut(rows.withColumn("held", F.crc32("x") % 3 == 0)))
    sizes = np.zeros((2, 4, 2))
    rows_of = [0, 0]
    for held, kind, label, n, many in cells.groupBy("held", "kind", "label").agg(F.sum("n"), F.count(F.lit(1))).collect():
        sizes[int(held), kind, label] = n
        rows_of[int(held)] += many
    if not sizes[0].sum(axis=0).all():
        return Model()
    weight = 1000 / np.maximum(50, sizes[0])  # both labels of a kind weigh alike
    start = boosted_trees.start_of((weight * sizes[0])[:, 1].sum(), (weight * sizes[0]).sum())
    if sum(rows_of) <= at_once:
        got = cells.orderBy("codes", "kind", "label").toArrow()
        codes = _matrix(got.column("codes"), np.uint8)
        kind, label, n, held = (got.column(c).to_numpy() for c in ("kind", "label", "n", "held"))
        trees = boosted_trees.grow(boosted_trees.at_once(codes[~held], label[~held], (weight[kind, label] * n)[~held]), edges, start, rounds)
        pools = _pools(kind[held], trees.raw_of(codes[held]), label[held], n[held])
    else:
        trees = boosted_trees.grow(_apart_sums(cells.where("not held"), rows_of[0], weight), edges, start, rounds)
        pools = _apart_pools(cells.where("held"), rows_of[1], trees)
    calibrated = [boosted_trees.shares(p) for p in pools]
    return Model(trees, calibrated, [boosted_trees.bar(c, p[:, 0], p[:, 1], SURE, LEAST) for c, p in zip(calibrated, pools)])


SPANS = "array<struct<kind: string, start: long, stop: long, probability: double>>"


def find(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of `docs`, by default all columns, with base_spans and spans (arrays by start, then kind; base ones have probability 1)."""
    carried = list(docs.columns if carry is None else carry)
    base_col, all_col = free("base_spans", docs.columns), free("spans", docs.columns)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("probability", pa.float64())]))
    show = lambda spans: [{"kind": KINDS[k], "start": s, "stop": e, "probability": p} for s, k, e, p in sorted(spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, MB):
            base, every = [], []
            for text in batch.column(text_col).to_pylist():
                own = base_spans(text) if text else []
                sure = [(*s, 1.0) for s in own]
                base.append(show(sure))
                every.append(show(sure + (model.added(text, own) if text else [])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(base, kind), pa.array(every, kind)], names=[*carried, base_col, all_col])
        release()

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return docs.mapInArrow(run, f"{schema}`{base_col}` {SPANS}, `{all_col}` {SPANS}")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span as its kind in brackets; of overlapping spans the first names the whole stretch."""
    merged = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("upto")),
        lambda a, s: F.struct(
            F.when(s["start"] >= a["upto"], F.concat(a["out"], F.substring(text, (a["upto"] + 1).cast("int"), (s["start"] - a["upto"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))).otherwise(a["out"]).alias("out"),
            F.greatest(a["upto"], s["stop"]).alias("upto"),
        ),
    )
    return F.concat(merged["out"], F.substring(text, (merged["upto"] + 1).cast("int"), F.lit((1 << 31) - 1)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs), carry=("doc_id",))
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    added = (F.size("spans") - F.size("base_spans")).cast("long").alias("n_added")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), added)
