"""Conversation repair against a search over whole edit strings that merges no states."""

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from matchwright.llm import conversation_repair as cr
from matchwright.llm.queries import ORACLE_SQL, QUERIES

LEGAL = re.compile(r"(s?(ua)+)?")
WAY = re.compile(r"s?(ua)*u?")
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def damage(conv, turn, role, text):
    show = lambda x: " " if x is None else str(x)
    what, role, text = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20, show(role), show(text)
    if what == 0:
        return []
    if what == 1:
        text = ""
    if what == 2:
        text = re.sub("[.!?]", "", text)
    if what == 4:
        role = "user"
    return [(turn, role, text)] * (2 if what == 3 else 1)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """The first complete edit string by (cost, string): every string is its own state."""
    queue = [(0, "", 0, ())]
    while True:
        cost, audit, i, out = heapq.heappop(queue)
        initials = "".join(r[:1] for r, _ in out)
        if i == len(rows) and LEGAL.fullmatch(initials):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        steps = [(2, "I", i, (*out, (r, ""))) for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((3, "D", i + 1, out))
            if marks[i] not in ("blank", "duplicate"):
                more = marks[i] == "truncated"
                if role:
                    steps.append((more, "K", i + 1, (*out, (role, text))))
                steps += [(2 + more, "R", i + 1, (*out, (r, text))) for r in ("user", "assistant")]
        for c, label, at, after in steps:
            if WAY.fullmatch("".join(r[:1] for r, _ in after)):
                heapq.heappush(queue, (cost + c, audit + label, at, after))


def plain(rows):
    want = {}
    convs = dict.fromkeys(r[0] for r in rows)
    for conv in convs:
        got = [x for r in rows if r[0] == conv for x in damage(*r)]
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        marks = faults(got)
        cost, audit, text = cheapest(got, marks)
        turns = {r[0] for r in got} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:]))
        want[conv] = (gaps, *[marks.count(m) for m in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return want


def found(df):
    out = {}
    for r in df.collect():
        assert r.conv_id not in out
        out[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
    return out


def made(n, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "What?", " \t", "", None, "Ünï!", "a\nb. ", "Yes.", "line\x0bend!"]
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 5, 6])):
            at = rng.choice([turn, turn, turn, turn * 3, None])
            rows.append((conv, at, rng.choice(["user", "assistant", "system", "tool", "", None, "Sam", "ursula"]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("piece", [1024, 2])
def test_against_search(spark, monkeypatch, piece):
    rows = made(250, 5)
    rows += [r for r in rows[:40]]  # repeated rows
    rows += [(None, 0, "user", "Hm."), (None, None, None, None), (7, None, "user", "Yes.")]
    monkeypatch.setattr(cr, "PIECE", piece)
    turns = spark.createDataFrame(rows, SCHEMA)
    if piece == 2:  # workers import the module anew, so the pieces are made and folded here
        for conv in range(60):
            own = [r for r in rows if r[0] == conv]
            codes = "".join(random.Random(conv).choice("suaSUA-_x") for _ in own * 3)
            whole = cr.shortest([codes])
            cuts = [codes[i : i + 2] for i in range(0, len(codes), 2)]
            assert cr.shortest([cr.matrix(c) for c in cuts]) == whole == cr.shortest(cuts)
        return
    want, got = plain(rows), found(cr.conversation_repair(cr.damaged(turns)))
    assert got == want
    assert any(w[6].count("I") for w in want.values()) and any("R" in w[6] for w in want.values())


def test_long_conversation_over_many_tasks(spark):
    """One conversation of many pieces and partitions, with a turn repeated over and over: the same as one walk."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(6000)] + [(1, 17, "user", "again and again.")] * 3000
    rows += [(2, i, "user", "hello.") for i in range(5)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(16)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(cr.conversation_repair(cr.damaged(turns)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    after = [x for r in rows if r[0] == 1 for x in damage(*r)]
    after.sort(key=lambda r: (r[0], r[1], r[2]))
    marks = faults(after)
    codes = "".join("x" if m in ("blank", "duplicate") else (r[1][:1].upper() if m else r[1][:1]) for r, m in zip(after, marks))
    cost, audit = cr.shortest([codes])
    assert got[1][1:4] == tuple(marks.count(m) for m in ("blank", "duplicate", "truncated"))
    assert got[1][5:7] == (cost, audit)
    state, text, turns_left = 0, [], iter(after)
    for label in audit:
        turn = next(turns_left) if label != "I" else (None, "", "")
        if label != "D":
            role = turn[1] if label == "K" else next(r for r in ("user", "assistant") if (state, r[0]) in cr.GRAMMAR)
            state = cr.GRAMMAR[state, role[0]]
            text.append(f"{role}:{turn[2]}")
    assert got[1][7] == hashlib.sha256("\n".join(text).encode()).hexdigest()


def test_query_on_small_tables(spark, tmp_path):
    rows = made(30, 9)
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit("x"), "piece": F.lit(1), "copies": F.lit(9)})
    extra.write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(QUERIES["op11_conversation_repair"](spark, str(tmp_path))) == plain(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{tmp_path}/conversations.parquet/*.parquet'")
    told = con.execute(ORACLE_SQL["op11_conversation_repair"]).fetchall()
    assert {r[0]: r[1:] for r in told} == plain(rows)
    extra.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    none = QUERIES["op11_conversation_repair"](spark, f"{tmp_path}/none")
    assert none.count() == 0 and none.columns[0] == "conv_id"


def test_all_dropped(spark):
    key = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = found(cr.conversation_repair(cr.damaged(spark.createDataFrame([(key, 0, "user", "Hello.")], SCHEMA))))
    assert got == {key: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_without_damage_and_long_texts(spark):
    """A text of megabytes goes through; a legal conversation costs nothing."""
    long_text = "word " * 1_000_000 + "end."
    rows = [(5, 0, "system", "Be kind."), (5, 1, "user", long_text), (5, 2, "assistant", "Fine.")]
    got = found(cr.conversation_repair(cr.as_they_are(spark.createDataFrame(rows, SCHEMA))))
    assert got[5][5:7] == (0, "KKK")
    assert got[5][7] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows).encode()).hexdigest()


def test_ties_take_the_least_string():
    assert cr.shortest(["u"]) == (2, "KI")
    assert cr.shortest(["a"]) == (2, "IK")
    assert cr.shortest(["s"]) == (3, "D")
    assert cr.shortest([""]) == (0, "")
