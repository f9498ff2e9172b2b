"""Each corpus operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re
import string
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchwright.llm import exact_dedup, line_dedup, nbest, ngram_join, packing, quality_rules, sharding, suffix_dedup, suffix_tree_lm, toxicity
from matchwright.llm.common import packed
from matchwright.llm.components import components, forest
from matchwright.llm.induced_sort import DiskQueue, sorted_suffixes

WS = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bucket string, _row long, kept string"


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = prose(40)
    texts = [prose(rng.randint(1, 120)) for _ in range(30)]
    base = prose(100)
    for _ in range(6):  # near copies
        w = base.split()
        w[rng.randrange(100)] = "changed"
        texts.append(" ".join(w))
    texts += [texts[0], texts[0].replace(" ", "\n"), base, base + " "]  # copies
    texts += [prose(20) + " " + shared + " " + prose(10) for _ in range(5)]  # a passage
    lines = [prose(5) for _ in range(4)]
    texts += ["\n".join([prose(3), *lines, prose(2)]), "\n".join(lines * 2), "\n\n\n\n", "a" * 500, "a\nb\nc\na\nb\nc"]
    texts += [None, "", None, "   ", "one two", "ONE two", "x", "a ▁ b\0c  d", prose(6000)]
    rows = [(i, t, "en", f"src{i % 3}", None, 0.5, "b", 7, "k") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[3], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None), (90, texts[4], "en", "s", 1, 1.0, "", 1, "")]
    return rows


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def unique(rows):
    """Rows whose id is there and stands once."""
    seen = collections.Counter(r[0] for r in rows)
    return {r[0]: r[1] for r in rows if r[0] is not None and seen[r[0]] == 1}


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


# ---- 1


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = [b"abcde", b"bad", b"abxyz"]
    auto = toxicity.build_automaton(terms)
    rng = random.Random(1)
    tokens = ["".join(rng.choice("abcdexyz-") for _ in range(rng.randint(1, 8))).encode() for _ in range(1500)] + terms + [b"abcd", b"abde", b"xabcde", b"abbcde", b"abcdeee"]
    raw, ends = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([len(t) for t in tokens])
    got = toxicity.matches(auto, raw, ends - [len(t) for t in tokens], ends)
    for t, v in zip(tokens, got):
        heads = [t[:k] for k in range(len(t) + 1)]
        exact = any(x in heads for x in terms)
        near = any(levenshtein(h, x) <= 1 for x in terms if len(x) >= 5 for h in heads)
        assert v == (2 if exact else 1 if near else 0), t


def test_marks_before_a_word_are_stripped_whatever_their_number():
    raw = np.frombuffer(b"[[[[[[[[wretch, ((( plain", np.uint8)
    start, stop, _ = toxicity.words_of(raw, np.array([0, len(raw)]))
    start, stop = toxicity.trimmed(raw, start, stop)
    assert [raw[a:b].tobytes() for a, b in zip(start, stop)] == [b"wretch,", b"", b"plain"]
    auto = toxicity.build_automaton([b"wretch"])
    assert toxicity.matches(auto, raw, start, stop).tolist() == [2, 0, 0]


def test_long_stems_stand_for_themselves():
    counts = toxicity.stem_counts([b"extraordinarily, fine", b"extraordinarily-"], [1, 0])
    assert counts[b"extraordinarily"] == [1, 1] and counts[b"extraordinar"] == [1, 1] and b"extraordinari" not in counts


def test_toxicity_learns_held_out(spark, docs, empty):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        w = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
        if toxic:
            w[rng.randrange(40)] = rng.choice(["vilest", "rotter", "wretch"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    table, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, marks)
    assert model.terms == [b"rotter", b"vilest", b"wretch"]
    held = toxicity.score(table, model).join(marks, "doc_id").where(toxicity.held_out())
    assert held.where((F.col("score") >= 0.5) != (F.col("toxic") == 1)).count() == 0
    near = toxicity.score(spark.createDataFrame([(1, "so vilezt and rottter here"), (2, "so mild and here")], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert near[0].n_hits == 2 and near[1].n_hits == 0 and near[0].score > near[1].score
    scored = toxicity.score(docs, model)
    assert scored.columns == [*docs.columns, "score_", "n_hits"] and scored.where("score_ between 0 and 1").count() == len(ROWS)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).where("score_ = 0").count() == len(ROWS)


# ---- 2


def test_two_pass_shuffle(spark, docs, empty, tmp_path):
    out = sharding.two_pass_shuffle(docs, 4, bucket_bytes=4096)
    got = out.collect()
    assert collections.Counter(tuple(r)[: len(ROWS[0])] for r in got) == collections.Counter(ROWS)
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert "bucket_" in out.columns
    key = lambda df: sorted((r.shard, r.slot, str(r.doc_id), str(r.text)) for r in df.collect())
    assert key(out) == key(sharding.two_pass_shuffle(docs.repartition(7), 4, bucket_bytes=4096))
    assert key(out) != key(sharding.two_pass_shuffle(docs, 4, seed=18, bucket_bytes=4096))
    assert sharding.two_pass_shuffle(empty, 4).count() == 0
    sharding.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(ROWS)


# ---- 3


def test_two_pass_shuffle_of_nested_columns(spark):
    kind = "doc_id long, text string, m map<string,int>, l array<struct<a:int>>, bucket string"
    rows = [(i % 5, "same", {"x": i % 2}, [(i % 3,)], "b") for i in range(40)] + [(None, None, None, None, None)]
    out = sharding.two_pass_shuffle(spark.createDataFrame(rows, kind), 4).collect()
    assert len(out) == 41 and sorted((r.shard, r.slot) for r in out) == sorted((k % 4, k // 4) for k in range(41))


def test_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    texts = [r[1] or "" for r in ROWS[:-10]] + ["a  b", "a  b", " \n x", "x   y", "don't we'll 12 3", "<|endoftext|> z", "\t tab", "é è  ", "a　b c"]
    coder = packing.Encoder(*packing.public_vocabulary())
    ids, first = coder.encode(*packed(pa.array(texts)))
    for k, t in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_packing(docs, empty):
    got = packing.pack(docs, *packing.public_vocabulary(), lane_bytes=16_000, window=256, quantum=32, with_ids=True).collect()
    coder = packing.Encoder(*packing.public_vocabulary())
    whole = collections.Counter()
    for r in ROWS:
        ids, first = coder.encode(*packed(pa.array([r[1]], pa.string())))
        whole[(r[0], tuple(ids.tolist()) + (0,))] += 1
    tokens = sum(len(k[1]) * n for k, n in whole.items())
    assert sum(r.length for r in got) == tokens and all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for ident, text in unique(ROWS).items():
        parts = sorted(by_doc[ident], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, np.uint32) for r in parts])
        assert (ident, tuple(ids.tolist())) in whole and [r.start for r in parts] == np.cumsum([0, *[r.length for r in parts[:-1]]]).tolist()
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append(r)
    assert sorted(seqs) == list(range(len(seqs)))
    for rs in seqs.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == np.cumsum([0, *[r.length for r in rs[:-1]]]).tolist() and sum(r.length for r in rs) <= 256
    assert packing.pack(empty, *packing.public_vocabulary()).count() == 0


def test_fill_keeps_proportions():
    queues = [[(k, 97) for k in range(60)], [(k, 31) for k in range(60, 120)], [(k, 400) for k in range(120, 130)]]
    totals = [sum(n for _, n in q) for q in queues]
    shares, served, n = [t / sum(totals) for t in totals], [0, 0, 0], 0
    for doc, _, take, window, _ in packing.fill(queues, shares, [0.0] * 3, 512, 64):
        served[0 if doc < 60 else 1 if doc < 120 else 2] += take
        n += take
        if n % 512 == 0:
            assert all(abs(n * s - x) <= 128 for s, x in zip(shares, served))
    assert served == totals


# ---- 4


def brute_lines(rows):
    seen, out = set(), {}
    for i, t in sorted(rows.items()):
        lines = (t or "").split("\n") if t is not None else []
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if not any(WORD.search(x) for x in w):
                continue
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = (len(lines), len(gone), None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_line_dedup(docs, empty):
    alone = unique(ROWS)
    one = docs.where(F.col("doc_id").isin(*alone))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in line_dedup.line_dedup(one).collect()}
    assert got == brute_lines(alone)
    assert line_dedup.line_dedup(docs).count() == len(ROWS) and line_dedup.line_dedup(empty).count() == 0


def test_native_operators_stay_native(docs):
    for df in (line_dedup.line_dedup(docs), quality_rules.ledger(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- 5


@pytest.mark.parametrize("digest", [16, 1])
def test_exact_dedup(docs, empty, digest):
    """A digest of one byte makes identifiers that fail their check; the result is the same."""
    groups = collections.defaultdict(list)
    for r in ROWS:
        groups[WS.sub(" ", r[1] or "")].append(r[0])
    want = collections.Counter()
    for text, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep, left = (min(real) if real else None), 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            want[(i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest())] += 1
    got = exact_dedup.exact_dedup(docs, digest=digest).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert collections.Counter(map(tuple, got.collect())) == want
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_chunks_do_not_depend_on_place():
    rng = random.Random(3)
    a, b = (bytes(rng.randrange(256) for _ in range(40_000)) for _ in range(2))
    one, two, three = exact_dedup.chunked([a, b + a, b"x" + a])
    assert b"".join(one) == a and b"".join(two) == b + a
    assert len(set(one) & set(two)) >= len(one) - 2 and len(set(one) & set(three)) >= len(one) - 2
    assert max(map(len, one)) <= exact_dedup.MAX_CHUNK


def test_without_copies(docs):
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({WS.sub(" ", r[1] or "") for r in ROWS})


# ---- 6


def test_suffix_tree_scores(docs, empty):
    train = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    got = suffix_tree_lm.suffix_tree_scores(docs, train, part_bytes=8192).collect()
    count = collections.Counter()
    for r in ROWS:
        if r[0] is None or r[0] % 3:
            count.update([*words_of(r[1]), None])
    n, v = sum(count.values()), len(count)
    texts = unique(ROWS)
    for r in got:
        assert r.train_tokens == n and math.isfinite(r.score) and r.score < 0
        if r.doc_id in texts:
            t = [*words_of(texts[r.doc_id]), None]
            base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
            assert r.n_tokens == len(t) and r.n_known == sum(count[x] > 0 for x in t) and abs(r.base_score - base) < 1e-6 * max(1, abs(base))
    held = [r for r in got if not r.train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert suffix_tree_lm.suffix_tree_scores(empty, train).count() == 0
    nothing = suffix_tree_lm.suffix_tree_scores(docs, F.lit(False), part_bytes=8192).collect()
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in nothing)


def plain_scores(texts, trained, least=2):
    """The model written out: every run of up to four symbols counted in one dictionary."""
    row = lambda t, sym: ["<", *[sym(w) for w in t], ">"]
    count = collections.Counter(w for t in trained for w in t)
    n = sum(count.values()) + len(trained)
    sym = lambda w: w if count[w] >= least else "?"
    rest = [c for c in count.values() if c < least]
    once, twice = sum(c == 1 for c in count.values()), sum(c == 2 for c in count.values())
    off = once / (once + 2 * twice) if once and twice else 0.5
    contexts = lambda r, i: [tuple(r[i - d : i]) for d in range(4) if d <= i and not {"<", "?"} & set(r[i - d + 1 : i])]
    after = collections.defaultdict(collections.Counter)
    for t in trained:
        r = row(t, sym)
        for i in range(1, len(r)):
            for c in contexts(r, i):
                after[c][r[i]] += 1
    total = {c: sum(x.values()) for c, x in after.items()}
    often = {c for c in after if total[c] >= 20}
    kept = set()
    for c in often - {()}:
        if sum(k * math.log(k / total[c] / (after[c[1:]][s] / total[c[1:]])) for s, k in after[c].items()) >= suffix_tree_lm.DIVERGES:
            kept |= {c[j:] for j in range(len(c))}
    size = sum(c >= least for c in count.values()) + 2
    out = []
    for t in texts:
        r, score = row(t, sym), 0.0
        for i in range(1, len(r)):
            p = 1 / size
            for c in contexts(r, i):
                if c == () or c in often:
                    p = (after[c][r[i]] + len(after[c]) * p) / (total[c] + len(after[c]))
                    best = p if c == () or c in kept else best  # noqa: F821
            score += math.log10(best)
            if r[i] == "?":
                w = t[i - 1]
                score += math.log10((count[w] - off if count[w] else off * len(rest) + 1) / (sum(rest) + 1)) if rest else 0
        out.append(score)
    return out, kept


def test_suffix_tree_scores_equal_plain_counts(docs):
    """Nothing is left out of the model: pairs seen once count, and each context seen 20 times can be retained."""
    train = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    got = {r.doc_id: r.score for r in suffix_tree_lm.suffix_tree_scores(docs, train, part_bytes=8192).collect()}
    texts = unique(ROWS)
    want, kept = plain_scores([words_of(t) for t in texts.values()], [words_of(r[1]) for r in ROWS if r[0] is None or r[0] % 3])
    assert kept
    for k, w in zip(texts, want):
        assert abs(got[k] - w) < 1e-6 * max(1, abs(w)), k


def test_rare_words_are_symbols(spark):
    """25 occurrences in 300,000 tokens make a word a symbol and a context, as they would in a small corpus."""
    rows = [(1, "x " * 300_000), (2, "p q z " * 25), (3, "p q"), (4, "q p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in suffix_tree_lm.suffix_tree_scores(docs, F.col("doc_id") < 3).collect()}
    assert got[3] > got[4] + 1


# ---- 7


def brute_suffixes(t, depth):
    t = t.tolist()
    sa = sorted(range(len(t)), key=lambda i: t[i:])
    lcp = [0]
    for a, b in zip(sa, sa[1:]):
        k = 0
        while k < depth and max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        lcp.append(k)
    return sa, lcp


def test_induced_sort():
    rng = random.Random(1)
    with tempfile.TemporaryDirectory() as folder:
        for _ in range(400):
            n, s = rng.randint(1, 60), rng.choice([1, 2, 3, 5, 50])
            t = [rng.randint(1, s) for _ in range(n)]
            if rng.random() < 0.5:
                t = (t[:10] * 8)[:n]
            t = np.array([*t, 0], np.uint8)
            sa, lcp = sorted_suffixes(t, 20, folder, limit=rng.choice([3, 1000]), base=rng.choice([2, 5, 1000]))
            want = brute_suffixes(t, 20)
            assert (sa.tolist(), lcp.tolist()) == want


def test_disk_queue_spills():
    rng = np.random.default_rng(2)
    with tempfile.TemporaryDirectory() as folder:
        q, want = DiskQueue(folder, 50), []
        for k in range(20):
            symbol = rng.integers(0, 9, 30)
            q.push(symbol, np.arange(30) + 30 * k, symbol * 100)
            want += zip(symbol.tolist(), (np.arange(30) + 30 * k).tolist())
        assert q.runs
        got = []
        while (c := q.least()) is not None:
            rank, suffix = q.pop()
            assert (suffix == c * 100).all()
            got += [(c, r) for r in rank.tolist()]
        assert got == sorted(want)


def brute_removed(texts, length):
    seen, out = set(), {}
    for i, t in texts:
        x = (t or "").encode()
        cover = bytearray(len(x))
        for p in range(len(x) - length + 1):
            s = x[p : p + length]
            if s in seen:
                cover[p : p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, c in zip(x, cover) if not c)
        out[i] = (len(x), len(x) - len(kept), (b"\0" + bytes(cover)).count(b"\0\1"), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length,gram", [(100, 32), (20, 8)])
def test_suffix_dedup(docs, empty, length, gram):
    texts = unique(ROWS)
    one = docs.where(F.col("doc_id").isin(*texts))
    out = suffix_dedup.suffix_dedup(one, length=length, gram=gram, shard_bytes=2000, queue_limit=500, base=100)
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == brute_removed(sorted(texts.items()), length)
    assert suffix_dedup.suffix_dedup(docs).count() == len(ROWS) and suffix_dedup.suffix_dedup(empty).count() == 0


def test_suffix_dedup_keeps_one_of_repeated_rows(spark):
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefg ") for _ in range(300))
    out = suffix_dedup.suffix_dedup(spark.createDataFrame([(1, text)] * 3 + [(None, text)], "doc_id long, text string").coalesce(1)).collect()
    assert sorted(r.n_removed for r in out) == [0, 300, 300, 300] and [r.n_removed for r in out if r.doc_id is None] == [300]


# ---- 8


def test_nbest_equals_brute_force():
    pieces = nbest.Pieces(nbest.public_model())

    def brute(text):
        m = nbest.MARK + text.replace("\0", "\0\0").replace(nbest.MARK, "\0\1").replace(" ", nbest.MARK)
        out = []

        def go(i, s, ids):
            if i == len(m):
                out.append((s, ids))
                return
            if m[i] == "\0":
                raw = b"\0" if m[i + 1] == "\0" else nbest.MARK.encode()
                go(i + 2, s + (pieces.lowest - nbest.UNKNOWN) * len(raw), ids + [pieces.bytes[b] for b in raw])
                return
            if m[i] not in pieces.ids:
                raw = m[i].encode()
                go(i + 1, s + (pieces.lowest - nbest.UNKNOWN) * len(raw), ids + [pieces.bytes[b] for b in raw])
            for j in range(i + 1, min(len(m), i + pieces.longest) + 1):
                if m[i:j] in pieces.ids:
                    go(j, s + pieces.ids[m[i:j]][1], ids + [pieces.ids[m[i:j]][0]])

        go(0, 0.0, [])
        return sorted(out, key=lambda x: -x[0])

    rng = random.Random(3)
    cache = nbest.Cache(pieces, 4, 10)
    for _ in range(60):
        texts = ["".join(rng.choice(["a", "e", "th", " ", "the", "\n", "▁", "\0", "ü"]) for _ in range(rng.randint(0, 7))) for _ in range(3)]
        for t, (scores, ways) in zip(texts, nbest._batch(*packed(pa.array(texts)), cache)):
            want = brute(t)
            assert [round(s, 5) for s in scores] == [round(s, 5) for s, _ in want[:4]]
            assert len({tuple(w.tolist()) for w in ways}) == len(ways) and all(nbest.decode(w.tolist(), pieces) == t for w in ways)
            assert [round(s, 5) for s, _ in nbest.encode(t, pieces, 4)] == [round(s, 5) for s in scores]


def test_lattices_equal_the_search_of_each_word():
    pieces = nbest.Pieces(nbest.public_model())
    rng = random.Random(4)
    letters = ["a", "e", "t", "h", "the", "in", "ing", "Ω", "𝄞", "ü", "中", "9", "-", "\n"]
    words = [" " * rng.randint(1, 2) + "".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [" " + "the" * 40, " a\0b", " ▁▁x"]
    column = pa.array([w.encode() for w in words], pa.large_binary())
    cache = nbest.Cache(pieces, 4, 10)
    score, loss, sizes, first, ids = cache.best(column)
    for k, w in enumerate(words):
        want = cache.all(w.encode())
        assert score[k] == pytest.approx(want[0][0]) and sum(pieces_score(pieces, i) for i in ids[first[k] : first[k] + sizes[k]]) == pytest.approx(want[0][0])
        assert loss[k] == pytest.approx(want[0][0] - want[1][0]) if len(want) > 1 else loss[k] == np.inf
        assert nbest.decode(ids[first[k] : first[k] + sizes[k]].tolist(), pieces) == w[1:]


def pieces_score(pieces, i):
    return pieces.ids[pieces.names[i]][1] if i in pieces.names else pieces.lowest - nbest.UNKNOWN


def test_segmented(docs, empty):
    got = nbest.segmented(docs, nbest.public_model(), 3).collect()
    assert len(got) == len(ROWS) and all(r.decodes for r in got if r.score is not None)
    assert sum(r.score is None and not r.ids for r in got) == sum(r[1] is None for r in ROWS)
    assert all(list(r.scores) == sorted(r.scores, reverse=True) for r in got)
    assert nbest.segmented(empty, nbest.public_model(), 3).count() == 0


# ---- 9


def brute_classes(texts, percent=75):
    sets = {}
    for i, t in texts.items():
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("short,percent", [(8, 75), (1, 75), (2, 50)])
def test_ngram_join(docs, short, percent):
    texts = unique(ROWS)
    one = docs.where(F.col("doc_id").isin(*texts))
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.classes(one, short=short, percent=percent).collect()}
    assert got == brute_classes(texts, percent)


def test_ngram_join_on_odd_rows(docs, empty):
    out = ngram_join.classes(docs)
    assert out.count() == len(ROWS) and ngram_join.classes(empty).count() == 0
    kept = ngram_join.without_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == out.where("stays").count()
    assert kept.where("text is null").count() == sum(r[1] is None for r in ROWS)


def test_needed_never_loses_a_link():
    rng = random.Random(9)
    for _ in range(3000):
        x = set(rng.sample(range(40), rng.randint(1, 30)))
        y = {v for v in x if rng.random() > 0.15} | set(rng.sample(range(40), rng.randint(0, 3)))
        if not y or 100 * len(x & y) < 75 * len(x | y):
            continue
        n = np.array([len(x), len(y)])
        p = np.minimum(n, n - ngram_join.least_overlap(n) + np.array([rng.choice(ngram_join.STEPS), rng.choice(ngram_join.STEPS)]))
        shared = len(set(sorted(x)[: p[0]]) & set(sorted(y)[: p[1]]))
        assert shared >= ngram_join.needed(n[:1], p[:1], n[1:], p[1:])[0] >= 1


def test_reach_bounds_the_overlap():
    rng = random.Random(10)
    for _ in range(300):
        base = rng.sample(range(60), 20)
        sets = [sorted({v for v in base if rng.random() > 0.2} | set(rng.sample(range(60), rng.randint(1, 8)))) for _ in range(6)]
        p = [len(x) - math.ceil(0.75 * len(x)) + rng.choice((1, 2, 4)) for x in sets]
        heads = [x[:k] for x, k in zip(sets, p)]
        count = collections.Counter(v for h in heads for v in h)
        reach = [len(x) - len(h) + sum(count[v] > 1 for v in h) for x, h in zip(sets, heads)]
        for i, j in itertools.combinations(range(6), 2):
            first = i if heads[i][-1] < heads[j][-1] else j
            bound = max(reach[i], reach[j]) if heads[i][-1] == heads[j][-1] else reach[first]
            assert len(set(sets[i]) & set(sets[j])) <= bound


def test_components(spark):
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(100, 300)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(9)).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}
    u, v = forest(np.array([5, 3, 9]), np.array([3, 1, 8]))
    assert dict(zip(u.tolist(), v.tolist())) == {3: 1, 5: 1, 9: 8}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- 10


def test_quality_rules(docs, empty):
    texts = unique(ROWS)
    got = {r.doc_id: r for r in quality_rules.ledger(docs).collect() if r.doc_id in texts}
    for i, t in texts.items():
        t, r = t or "", got[i]
        w = WORD.findall(t)
        wins = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        many = collections.Counter(wins)
        cover = {k + j for k, x in enumerate(wins) if many[x] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
    assert quality_rules.ledger(empty).count() == 0
    rows = quality_rules.ledger(docs)
    failed = rows.where("failures & 63 <> 0").select("failures").collect()
    for r in quality_rules.ablations(rows, 2).collect():
        assert r.n_failed == sum(x.failures >> r.bit & 1 for x in failed) and r.n_only == sum(x.failures == 1 << r.bit for x in failed)


# ---- the pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, labels, passage = [], [], prose(60)
    for i in range(200):
        t = prose(80)
        if i % 4 == 0:
            t += " vilest " + prose(5)
        if i in (11, 13):
            t = prose(30) + " " + passage + " " + prose(40)
        rows.append((i, t))
        labels.append((i, 1, int(i % 4 == 0)))
    w = rows[1][1].split()
    w[40] = "other"
    rows += [(200, rows[1][1]), (201, " ".join(w)), (202, None), (203, ""), (204, "é " * 300)]
    docs = spark.createDataFrame([(i, t, "en", "s", None, 1.5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    at, ids = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, at, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/{k}")
        at = spark.read.parquet(f"{folder}/{k}")
        ids.append({r.doc_id for r in at.select("doc_id").collect()})
    clean = {i for i, _ in rows if i >= 200 or i % 4}
    assert ids[0] == clean
    assert ids[1] == clean - {200, 203}  # null and empty are the same text
    assert ids[2] == clean - {200, 203, 201}
    assert ids[3] == ids[2]
    before = {i: (t or "").encode() for i, t in rows if i in ids[2]}
    want = brute_removed(sorted((i, b.decode()) for i, b in before.items()), 100)
    got = {r.doc_id: r.text for r in at.collect()}
    for i in ids[2] - {204}:
        assert hashlib.sha256((got[i] or "").encode()).hexdigest() == want[i][3], i
    assert len(got[13]) < len(before[13]) - 250 and got[11].encode() == before[11]
    pieces = corpus_pipeline.run(spark, folder).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert {r.doc_id for r in pieces.where("n = m").collect()} == ids[3]


# ---- adversarial words, wide strings, typographic marks, chosen mixtures


def morse(n, low="a", high="b"):
    return "".join((low, high)[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096, 16384])
def test_words_of_thue_and_morse_stay_apart(spark, n):
    """Two words that a polynomial modulo 2**64 cannot tell apart: joined sets, counts of words."""
    one, two = morse(n), morse(n, "b", "a")
    docs = spark.createDataFrame([(0, one), (1, two), (2, one)], "doc_id long, text string").repartition(2)
    got = {r.id: r.component_id for r in ngram_join.classes(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 0}
    scores = {r.doc_id: r for r in suffix_tree_lm.suffix_tree_scores(docs, F.lit(True)).collect()}
    under = 6 + 0.1 * (3 + 1)
    base = lambda c: math.log10((c + 0.1) / under) + math.log10((3 + 0.1) / under)
    assert all(math.isclose(scores[i].base_score, base(c), rel_tol=1e-9) for i, c in ((0, 2), (1, 1), (2, 2)))


@pytest.mark.parametrize("length,gram", [(400, 32), (700, 64)])
def test_long_strings_are_removed_whole(spark, length, gram):
    """Strings far longer than a byte counts."""
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = letters(900)
    texts = [letters(300) + shared + letters(200), letters(10) + shared, shared[:length] + letters(40), shared[: length - 1] + "#" + letters(40), letters(2000)]
    rows = list(enumerate(texts))
    out = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), length=length, gram=gram)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in out.collect()}
    assert got == {0: (0, 0), 1: (900, 1), 2: (length, 1), 3: (0, 0), 4: (0, 0)}


@pytest.mark.parametrize("before,after", [("\u201c", "\u201d"), ("\u00ab", "\u00bb"), ("\u2014", ""), ("\u2018\u201c", "\u2026"), ("\u00bf", "?"), ("\U0001f600", "")])
def test_marks_do_not_hide_terms(before, after):
    auto = toxicity.build_automaton([b"scum", b"vilest"])
    for word, want in (("scum", 2), ("vilest", 2), ("vilxst", 1), ("garden", 0)):
        raw, offsets = packed(pa.array([f"the {before}{word}{after} here \u00e9t\u00e9"]))
        x = toxicity.features(auto, raw, offsets)[0]
        assert (x[5], x[6]) == (float(want == 2), float(want == 1)), (before, word)
    assert toxicity.bare(f"scum{after}".encode()) == b"scum"
    quoted = [toxicity.features(auto, *packed(pa.array([t])))[0][4] for t in (f"he said {before}scum{after} here", "he said scum here")]
    assert quoted == [float(after in ("\u201d", "\u00bb")), 0.0]


def test_packing_keeps_a_chosen_mixture(spark):
    """Every full window holds the target shares, within some quanta, while all sources last; what one window lacks the next makes good."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["tea", "milk", "bread", "salt"]) for _ in range(rng.randint(20, 400))), s) for i, s in enumerate(["a"] * 300 + ["b"] * 300 + ["c"] * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    targets = {"a": 0.5, "b": 0.3, "c": 0.2}
    out = packing.pack(docs, *packing.public_vocabulary(), targets=targets).collect()  # one lane
    total, by = collections.Counter(), collections.Counter()
    for r in out:
        total[r.sequence_id] += r.length
        by[r.sequence_id, r.source] += r.length
    left = collections.Counter()
    for r in out:
        left[r.source] += r.length
    used, lasting = collections.Counter(), []
    for s in sorted(total):
        if all(used[k] + 2 * packing.WINDOW <= left[k] for k in targets) and total[s] == packing.WINDOW:
            lasting.append(s)
        for k in targets:
            used[k] += by[s, k]
    assert len(lasting) > 20
    for k, share in targets.items():
        assert all(abs(by[s, k] - share * packing.WINDOW) <= 2 * packing.QUANTUM for s in lasting), k
        assert abs(sum(by[s, k] for s in lasting) / (packing.WINDOW * len(lasting)) - share) < 0.02
    assert sum(left.values()) == sum(r.length for r in out)
