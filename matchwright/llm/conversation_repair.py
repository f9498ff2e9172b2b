"""Repair of conversations by weighted finite-state composition.

Three machines are composed: the acceptor of a conversation's turns (a chain), a transducer of edits (keep, rerole, delete,
insert) and the acceptor of legal role sequences, `(s?(ua)+)?`. Their composition is never built: its states (turns read,
grammar state) are expanded in topological order, and the shortest path is taken over the weights (cost, edits' initials),
compared cost first. Two paths of equal cost to one state read the same turns, so neither's string begins the other's, and
the order survives whatever follows: weights of parts compose.

That is used for long conversations. Turns are sorted and dealt by ranges of (conversation, turn, role, text), so that a
conversation may lie in many tasks. A task cuts its turns into pieces of `PIECE`; a full piece is reduced to the weights
from every grammar state to every other, a shorter one to its codes. The last step streams the turns of a conversation after
its pieces: it folds the pieces from the start state, then walks the turns with the cheapest edits and hashes as it goes; a
digest of a whole conversation is sequential, but it holds no more than a batch of turns, and the edits, which are its result.

Equal turns (conversation, turn, role, text) are one row with a number before anything is sorted: after the first, the
others are duplicates. Duplicates of earlier turns are found by partial aggregation over digests of texts.

Cases: null roles and texts are one space, null turns come first, a null conversation is a conversation; turns with equal
numbers follow by role, then text (texts alike in their first `HEAD` characters by digest). A role without characters has no
initial: it is never legal and cannot be kept. A table without rows gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm.common import cut, sliced, table

PIECE, HEAD = 1024, 64
SPACES = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: The acceptor of `(s?(ua)+)?`: 0 start, 1 after a system turn, 2 after a user's, 3 after an assistant's.
GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL, STATES = (0, 3), 4
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: A turn's code: its role's initial (`-` for one that is never legal), upper case where the turn is truncated; `x` must go.
GONE = "x"

Weight = tuple[int, str]


def edits(code: str) -> list[tuple[str, str, int]]:
    """(edit, role initial that comes out, cost) of the transducer for one turn."""
    if code == GONE:
        return [(DELETE, "", COST[DELETE])]
    more = int(code.isupper() or code == "_")
    own = [(KEEP, code.lower(), COST[KEEP] + more)] if code not in "-_" else []
    return [(DELETE, "", COST[DELETE]), *own, *[(REROLE, r, COST[REROLE] + more) for r in ROLES]]


def _inserted(at: dict[int, Weight]) -> dict[int, Weight]:
    """Weights after inserts, which read nothing: states in order of cost, as an insert always adds some."""
    done, open_ = {}, dict(at)
    while open_:
        q = min(open_, key=open_.get)
        w = done[q] = open_.pop(q)
        for r in ROLES:
            to = GRAMMAR.get((q, r))
            if to is not None and to not in done:
                new = (w[0] + COST[INSERT], w[1] + INSERT)
                open_[to] = min(open_.get(to, new), new)
    return done


def relaxed(codes: str, start: int) -> dict[int, Weight]:
    """The least weights from a grammar state over the turns to each state, with inserts before the turns but not after them."""
    at: dict[int, Weight] = {start: (0, "")}
    for code in codes:
        arcs, to_all = edits(code), {}
        for q, (cost, labels) in _inserted(at).items():
            for label, r, c in arcs:
                to = GRAMMAR.get((q, r)) if r else q
                if to is not None:
                    new = (cost + c, labels + label)
                    if to not in to_all or new < to_all[to]:
                        to_all[to] = new
        at = to_all
    return at


@lru_cache(maxsize=20_000)
def _short(codes: str, start: int) -> dict[int, Weight]:
    return relaxed(codes, start)


def matrix(codes: str) -> list[dict[int, Weight]]:
    return [_short(codes, q) if len(codes) <= 16 else relaxed(codes, q) for q in range(STATES)]


def shortest(pieces: list[list[dict[int, Weight]] | str]) -> Weight:
    """The least weight over the pieces, each its codes or its matrix, from the start to a final state."""
    at: dict[int, Weight] = {0: (0, "")}
    for piece in pieces:
        after: dict[int, Weight] = {}
        for q, (cost, labels) in at.items():
            steps = piece[q] if not isinstance(piece, str) else _short(piece, q) if len(piece) <= 16 else relaxed(piece, q)
            for to, (c, more) in steps.items():
                new = (cost + c, labels + more)
                if to not in after or new < after[to]:
                    after[to] = new
        at = after
    at = _inserted(at)
    return min(at[q] for q in FINAL if q in at)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies: each turn after the damage that its key's checksum asks for; copies is 0, 1 or 2."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in (conv, None, turn)])
    what = F.crc32(key.cast("binary")) % 20
    said, who = F.coalesce(F.col(text), F.lit(" ")), F.coalesce(F.col(role), F.lit(" "))
    said = F.when(what == 1, F.lit("")).when(what == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said)
    copies = F.when(what == 0, 0).when(what == 3, 2).otherwise(1).cast("long")
    return turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.when(what == 4, F.lit("user")).otherwise(who).alias("role"), said.alias("text"), copies.alias("copies"))


def as_they_are(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same columns without damage: for the repair of real tables."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), F.lit(1).cast("long").alias("copies"))


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def _marked(turns: DataFrame) -> DataFrame:
    """Distinct turns without their texts: how many copies, and whether blank, truncated, or seen in an earlier turn."""
    end = F.substring(_trimmed(F.col("text")), -1, 1)
    keys = turns.select(
        "conv", "turn", "role", F.substring("text", 1, HEAD).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"), "copies",
        (F.length(_trimmed(F.col("text"))) == 0).alias("blank"), (~end.isin(".", "!", "?")).alias("truncated"),
    )
    keys = cut(keys.groupBy("conv", "turn", "role", "head", "digest").agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")))
    when = F.struct(F.col("turn"))  # nulls lowest
    twice = keys.where("copies > 0").groupBy(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"))
    twice = twice.agg(F.min(when).alias("_first"), F.max(when).alias("_last")).where("_first < _last").drop("_last")
    met = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    return keys.join(twice, met, "left").withColumn("again", F.coalesce(F.col("_first") < when, F.lit(False))).drop("_conv", "_role", "_digest", "_first")


ORDER = ("turn", "role", "head", "digest")
COUNTS = ("blank", "duplicate", "truncated", "illegal")
SUMS = "lo long, hi long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string"
PIECES = f"part int, seq long, codes string, weights array<struct<a: int, b: int, cost: long, labels: string>>, {SUMS}"


class Piece:
    """Up to PIECE turns of one conversation that follow each other, and what is counted over them."""

    def __init__(self, conv: object, part: int, seq: int) -> None:
        self.conv, self.part, self.seq = conv, part, seq
        self.codes: list[str] = []
        self.n = dict.fromkeys(COUNTS, 0)
        self.lo = self.hi = self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, fault: str | None) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.n["illegal"] += 1
        self.last = initial
        if turn is not None and turn != self.hi:
            self.lo, self.hi, self.turns = turn if self.lo is None else self.lo, turn, self.turns + 1
        if fault:
            self.n[fault] += 1
        code = initial if initial and initial in "sua" else "-"
        if fault == "truncated":
            code = "_" if code == "-" else code.upper()
        self.codes.append(GONE if fault in ("blank", "duplicate") else code)

    def row(self) -> dict:
        codes = "".join(self.codes)
        weights = [{"a": a, "b": b, "cost": c, "labels": s} for a, to in enumerate(matrix(codes)) for b, (c, s) in to.items()] if len(codes) >= PIECE else None
        return {"conv": self.conv, "part": self.part, "seq": self.seq, "codes": None if weights else codes, "weights": weights, "lo": self.lo, "hi": self.hi, "turns": self.turns, **self.n, "first": self.first, "last": self.last}


def _pieces(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, done, seq = TaskContext.get().partitionId(), None, [], 0
        for batch in batches:
            names = ("conv", "turn", "role", "copies", "blank", "truncated", "again")
            for conv, turn, role, copies, blank, truncated, again in zip(*[batch.column(c).to_pylist() for c in names]):
                if piece is None or piece.conv != conv:
                    if piece is not None:
                        done.append(piece.row())
                    seq += 1
                    piece = Piece(conv, part, seq)
                for k in range(copies):
                    if len(piece.codes) >= PIECE:
                        done.append(piece.row())
                        seq += 1
                        piece = Piece(conv, part, seq)
                    piece.add(turn, role, "blank" if blank else "duplicate" if again or k else "truncated" if truncated else None)
                    if len(done) >= 4096:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done = []
            if len(done) >= 512:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if piece is not None:
            done.append(piece.row())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


class Told:
    """One conversation in the last step: its pieces first, then its turns."""

    def __init__(self, conv: object) -> None:
        self.conv, self.parts = conv, []
        self.n = dict.fromkeys(COUNTS, 0)
        self.lo = self.hi = self.last = None
        self.turns = 0
        self.audit = None

    def piece(self, p: dict) -> None:
        if p["first"] is not None:
            if self.last is not None and self.last + p["first"] not in LEGAL:
                self.n["illegal"] += 1
            self.last = p["last"]
        for c in COUNTS:
            self.n[c] += p[c]
        if p["lo"] is not None:
            self.turns += p["turns"] - (p["lo"] == self.hi)
            self.lo, self.hi = p["lo"] if self.lo is None else self.lo, p["hi"]
        if p["weights"] is not None:
            m: list[dict[int, Weight]] = [{} for _ in range(STATES)]
            for w in p["weights"]:
                m[w["a"]][w["b"]] = (w["cost"], w["labels"])
            self.parts.append(m)
        else:
            self.parts.append(p["codes"])

    def begin(self) -> None:
        self.cost, self.audit = shortest(self.parts)
        self.parts, self.sha, self.any, self.at, self.state = [], hashlib.sha256(), False, 0, 0
        self._inserts()

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            self._out(self._missing(), "")

    def _missing(self) -> str:
        return next(ROLES[r] for r in ROLES if (self.state, r) in GRAMMAR)

    def _out(self, role: str, text: str) -> None:
        self.state = GRAMMAR[self.state, role[:1]]
        self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any = True

    def turn(self, role: str, text: str, copies: int) -> None:
        if self.audit is None:
            self.begin()
        for _ in range(copies):
            label = self.audit[self.at]
            self.at += 1
            if label != DELETE:
                self._out(role if label == KEEP else self._missing(), text)
            self._inserts()

    def row(self) -> dict:
        if self.audit is None:
            self.begin()
        gaps = 0 if self.lo is None else self.hi - self.lo + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, **self.n, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.sha.hexdigest()}


def _told(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in sliced(batches, "text"):
            cols = [batch.column(c).to_pylist() for c in ("conv", "role", "text", "copies")]
            pieces = batch.column("piece")
            for i, (conv, role, text, copies) in enumerate(zip(*cols)):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = Told(conv)
                if copies is None:
                    now.piece(pieces[i].as_py())
                else:
                    now.turn(role, text, copies)
            if len(done) >= 1024:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _arrow(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def conversation_repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, the faults' counts, cost, audit and repaired_sha256 for each conversation of conv, turn, role, text, copies.

    A conversation whose turns all have 0 copies is there too, as an empty one.
    """
    spark = turns.sparkSession
    kind = turns.schema["conv"].dataType
    keys = ("conv", *ORDER)
    spread = _marked(turns).repartitionByRange(*keys).sortWithinPartitions(*keys)
    piece_schema = spark.createDataFrame([], f"conv {kind.simpleString()}, {PIECES}").schema
    found = cut(spread.mapInArrow(_pieces(_arrow(piece_schema)), piece_schema))
    one = found.select("conv", F.struct(*[c for c in found.columns if c != "conv"]).alias("piece"), F.lit(0).alias("kind"), "part", "seq")
    two = turns.where("copies > 0").select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "copies", F.substring("text", 1, HEAD).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"))
    both = one.unionByName(two, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "kind", "part", "seq", *ORDER)
    out = spark.createDataFrame([], f"conv_id {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string").schema
    return both.select("conv", "piece", "role", "text", "copies").mapInArrow(_told(_arrow(out)), out)


#: The same rows: a checksum by bits, states joined turn by turn, the output read off the edits. For short conversations.
OP11_SQL = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations
), summed AS (
    SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))))) % 20 AS what
    FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role, CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM summed
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM damaged
), marked AS (
    SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN time > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS earlier
    FROM placed
), counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (earlier IS NOT NULL AND concat(earlier, initial) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), grammar(q, r, next) AS (
    VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserted(q, next, cost, labels) AS (
    VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'), (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')
), edit AS (
    SELECT conv_id, k, q, next, 'K' AS label, CAST(fault = 'truncated' AS INTEGER) AS cost FROM marked JOIN grammar ON r = initial WHERE fault IN ('', 'truncated')
    UNION ALL SELECT conv_id, k, q, next, 'R', 2 + CAST(fault = 'truncated' AS INTEGER) FROM marked, grammar WHERE r <> 's' AND fault IN ('', 'truncated')
    UNION ALL SELECT conv_id, k, q, q, 'D', 3 FROM marked, (VALUES (0), (1), (2), (3)) AS s(q)
), way(conv_id, k, q, w) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': ''} FROM damaged
    UNION ALL
    SELECT way.conv_id, way.k + 1, e.next, min({'cost': w.cost + i.cost + e.cost, 'audit': concat(w.audit, i.labels, e.label)})
    FROM way JOIN inserted i ON i.q = way.q JOIN edit e ON e.conv_id IS NOT DISTINCT FROM way.conv_id AND e.k = way.k + 1 AND e.q = i.next GROUP BY way.conv_id, way.k, e.next
), best AS (
    SELECT way.conv_id, min({'cost': w.cost + i.cost, 'audit': concat(w.audit, i.labels)}) AS w
    FROM way JOIN counted c ON c.conv_id IS NOT DISTINCT FROM way.conv_id AND way.k = c.n JOIN inserted i ON i.q = way.q WHERE i.next IN (0, 3) GROUP BY way.conv_id
), label AS (
    SELECT conv_id, p, w.audit[p] AS label FROM (SELECT conv_id, w, unnest(range(1, len(w.audit) + 1)) AS p FROM best)
), walked AS (
    SELECT conv_id, p, label, count(*) FILTER (label <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS k FROM label
), kept AS (
    SELECT w.conv_id, w.p, w.label, m.role, m.text, row_number() OVER (PARTITION BY w.conv_id ORDER BY w.p) AS o, first_value(w.label = 'K' AND m.initial = 's') OVER (PARTITION BY w.conv_id ORDER BY w.p) AS led
    FROM walked w LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.k = w.k AND w.label <> 'I' WHERE w.label <> 'D'
), told AS (
    SELECT conv_id, string_agg(concat(CASE WHEN label = 'K' THEN role WHEN (o - CAST(coalesce(led, false) AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':', coalesce(text, '')), chr(10) ORDER BY p) AS said
    FROM kept GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    CAST(coalesce(b.w.cost, 0) AS BIGINT) AS cost, coalesce(b.w.audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
"""


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair(damaged(table(spark, sf_dir, "conversations")))
