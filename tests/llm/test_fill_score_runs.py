"""Fill-in-the-middle, context-tree scores and word runs against plain versions."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from functools import lru_cache

import numpy as np
import pytest

from quarry.llm import context_tree, fill_middle, word_runs
from quarry.llm.common import table

from .helpers import SCHEMA, clashing, edge_docs, empty_docs, words

SF_SMALL = "/root/testdata/sf0.001"
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def small(spark):
    return table(spark, SF_SMALL, "documents")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


QUERIES = {"op11": fill_middle.query, "op12": context_tree.query, "op13": word_runs.query}


@pytest.mark.parametrize("name", QUERIES)
def test_edges(spark, name):
    docs, query = edge_docs(spark), QUERIES[name]
    rows = [tuple(r) for r in query(docs).collect()]
    assert collections.Counter(r[0] for r in rows) == collections.Counter(r["doc_id"] for r in docs.collect())
    twice = [r for r in rows if r[0] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    other = query(clashing(docs))
    assert other.columns == query(docs).columns
    near = lambda rs: sorted(repr([f"{v:.6f}" if isinstance(v, float) else v for v in r]) for r in rs)
    assert near(rows) == near(map(tuple, other.collect()))
    assert query(empty_docs(spark)).collect() == []


# 11 -----------------------------------------------------------------------------------

def filled(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, form, out, chars = len(units), "plain", text, (None, None)
    if doc_id is not None and text and not any(s in text for s in ("<P>", "<S>", "<M>")):
        h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
        if h3 % 100 < 90:
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
            form = "spm" if h4 % 100 < 20 else "psm"
            out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
            chars = (len(p), len(m))
    return doc_id, n, form, *chars, out


def odd_docs(spark):
    rng = random.Random(4)
    odd = ["<P>", "a <S> b", "<", "<P", "x<S<M", "<P <S <M", "é", "日本 a\nb\t", "<" * 40, "A" * 9000, "1" * 9000,
           "\n" * 9000, "ab<\nM>c"]
    odd += ["".join(rng.choice("ab<PSM>é \n") for _ in range(rng.randrange(30))) for _ in range(60)]
    rows = [(k, t, "en", "a", 1) for k, t in enumerate(odd)] * 2
    rows += [(None, "some words here", "en", "a", 1)] * 3 + [(None, "<P>", "en", "a", 1), (None, None, "en", "a", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("make", [small, edge_docs, odd_docs])
def test_fill_middle(spark, make):
    docs = make(spark)
    rows = plain(docs.collect())
    want = sorted(repr((*w[:5], sha(w[5]), sha(t or ""))) for w, (_, t) in ((filled(*r), r) for r in rows))
    assert want == sorted(repr(tuple(r)) for r in fill_middle.query(docs).collect())
    outs = fill_middle.outputs(docs)
    assert sorted(repr(filled(*r)) for r in rows) == sorted(repr(tuple(r)) for r in outs.collect())
    assert sorted(repr((i, t or "")) for i, t in rows) == sorted(repr(tuple(r)) for r in fill_middle.restored(outs).collect())


def test_fill_middle_in_small_pieces_and_one_shuffle(spark, monkeypatch):
    docs = odd_docs(spark)
    key = lambda f: sorted(repr(tuple(r)) for r in f.collect())
    want = key(fill_middle.query(docs))
    monkeypatch.setattr(fill_middle, "CHUNK", 2)
    assert key(fill_middle.query(docs)) == want
    plan = fill_middle.query(small(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# 12 -----------------------------------------------------------------------------------

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text):
    return words((text or "").translate(LOW))


def left_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def decisions(tokens):
    b = ("\n" * 5 + "".join(x + " " for x in tokens) + "\n").encode()
    for k in range(5, len(b)):
        for j in range(8):
            yield (1 << j) | (b[k] >> (8 - j)), b[k - 5:k][::-1], (b[k] >> (7 - j)) & 1


def tree_scores(rows):
    """Context-tree weighting by recursion over a dictionary of nodes."""
    counts = collections.Counter()
    seen, children = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)
    for doc_id, text in rows:
        if not left_out(doc_id):
            tokens = lowered(text)
            counts.update(tokens + ["\n"])
            for node, ctx, bit in decisions(tokens):
                for d in range(6):
                    seen[node, ctx[:d]][bit] += 1
                    if d < 5:
                        children[node, ctx[:d]].add(ctx[:d + 1])
    total, kinds = sum(counts.values()), len(counts)

    def own(node, ctx):
        a, b = seen[node, ctx]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(node, ctx):
        e = own(node, ctx)
        if len(ctx) == 5:
            return e
        s = sum(weighted(node, c) for c in children[node, ctx])
        return math.log(.5) + max(e, s) + math.log1p(math.exp(-abs(e - s)))

    def probability(node, ctx, bit, d=0):
        if (node, ctx[:d]) not in seen:
            return None
        pair = seen[node, ctx[:d]]
        estimate = (pair[bit] + .5) / (sum(pair) + 1)
        deeper = probability(node, ctx, bit, d + 1) if d < 5 else None
        if deeper is None:
            return estimate
        weight = math.exp(math.log(.5) + own(node, ctx[:d]) - weighted(node, ctx[:d]))
        return weight * estimate + (1 - weight) * deeper

    for doc_id, text in rows:
        tokens = lowered(text)
        logs = [probability(*x) for x in decisions(tokens)]
        score = sum(math.log10(.5 if p is None else p) for p in logs)
        tokens.append("\n")
        base = sum(math.log10((counts[x] + .1) / (total + .1 * (kinds + 1))) for x in tokens)
        yield doc_id, left_out(doc_id), len(tokens), sum(counts[x] > 0 for x in tokens), total, base, score


def unlearnt(spark):
    return spark.createDataFrame([(None, "Words of nobody", "en", "a", 1), (None, None, "en", "a", 1)], SCHEMA)


@pytest.mark.parametrize("make", [lambda s: small(s).limit(40), edge_docs, unlearnt], ids=["small", "edges", "unlearnt"])
def test_context_tree_scores(spark, make):
    docs = make(spark)
    key = lambda r: (str(r[0]), r[2], r[6])
    got = sorted((tuple(r) for r in context_tree.query(docs).collect()), key=key)
    want = sorted(tree_scores(plain(docs.collect())), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:7] == pytest.approx(w[5:7], rel=1e-9, abs=1e-9)


def test_context_tree_in_many_blocks_and_stretches(spark, monkeypatch):
    docs = small(spark)
    key = lambda f: {r["doc_id"]: (r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in f.collect()}
    want = key(context_tree.scores(docs))
    assert context_tree.blocks(docs, 20_000)[1] > 20
    monkeypatch.setattr(context_tree, "STRETCH", 500)
    monkeypatch.setattr(context_tree, "SLICE", 3000)
    assert key(context_tree.scores(docs, 20_000)) == want


def test_next_byte_probabilities_add_up_to_one(spark):
    """All 256 bytes behind some contexts, seen and never seen."""
    from pyspark.sql import functions as F
    docs = small(spark).limit(30)
    asked = docs.select(F.lit(0).alias("block"), F.lit(True).alias("learn"), "text").mapInArrow(
        context_tree._count, context_tree.ASKED)
    every = [int.from_bytes(c[::-1], "big") << 8 | b for c in (b" the ", b"\n\n\n\n\n", b"zqxjk", b"n the") for b in range(256)]
    more = spark.createDataFrame([(0, r, None, 0) for r in every], context_tree.ASKED)
    lp = {r["run"]: r["lp"] for r in context_tree.model(asked.unionByName(more)).collect()}
    for k in range(0, len(every), 256):
        assert sum(10 ** lp[r] for r in every[k:k + 256]) == pytest.approx(1, abs=1e-9)


def test_held_out_texts_score_above_the_base(spark):
    rows = [r for r in context_tree.query(table(spark, "/root/testdata/sf0.01", "documents")).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 3.5, 17.5, 100.5, 1e6 + 0.5, 1e12])
    assert np.allclose(context_tree.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-11)


# 13 -----------------------------------------------------------------------------------

def runs_of(w, least=12):
    """Runs by comparing the sequence with itself shifted by every period."""
    found = set()
    for q in range(1, len(w) // 2 + 1):
        k = 0
        while k + q < len(w):
            e = k
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            n = e - k + q
            if e > k and n >= max(least, 2 * q) and not any(
                    q % p == 0 and all(w[x] == w[x + p] for x in range(k, k + n - p)) for p in range(1, q)):
                found.add((k, n, q))
            k = max(e, k + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_row(doc_id, text):
    w = words(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a, g = (h // 10) % len(w), h // 10
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, len(w))]
    found = runs_of(w)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = (None,) * 4
    if found:
        s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    return (doc_id, len(w), len(found), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def periodic_docs(spark):
    rng = random.Random(6)
    rows = []
    for k in range(150):
        n, kinds = rng.randrange(120), rng.choice((1, 2, 3, 8))
        w = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        for _ in range(rng.randrange(3)):
            p, a, e = rng.randint(1, 20), rng.randrange(n + 1), rng.randrange(n + 1)
            w = [w[a + (x - a) % p] if a <= x < e else w[x] for x in range(n)]
        rows.append((k, rng.choice((" ", "\n", " \t")).join(w), "en", "a", 1))
    thue = ["a"]
    for _ in range(9):
        thue += ["b" if x == "a" else "a" for x in thue]
    rows += [(1000, " ".join(thue), "en", "a", 1), (None, "x " * 50, "en", "a", 1), (1001, "x " * 3000, "en", "a", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("make", [lambda s: small(s).where("length(text) < 8000"), periodic_docs], ids=["small", "periodic"])
def test_word_runs(spark, make):
    docs = make(spark)
    want = sorted(repr(runs_row(*r)) for r in plain(docs.collect()))
    assert want == sorted(repr(tuple(r)) for r in word_runs.query(docs).collect())


def test_runs_and_collapsed_texts(spark):
    docs = periodic_docs(spark)
    rows = plain(docs.collect())
    want = sorted(repr((i, *r)) for i, t in rows for r in runs_of(words(t)))
    assert want == sorted(repr(tuple(r)) for r in word_runs.runs(docs).collect())
    for r in word_runs.collapse(docs).where("doc_id = 1001 OR doc_id IS NULL").collect():
        assert r["text"] == "x"


def test_lyndon_arrays_by_grouping():
    rng = random.Random(8)
    for _ in range(400):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 20))]
        longest = [max(e - k for e in range(k + 1, len(s) + 1)
                       if all(s[k:e] < s[m:e] for m in range(k + 1, e))) for k in range(len(s))]
        assert word_runs.lyndon(s, 4) == longest


def test_words_that_share_a_hash_are_told_apart(spark, monkeypatch):
    docs = small(spark).limit(50)
    key = lambda f: {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in f.collect()}
    import pyarrow as pa
    s = context_tree.Stream(np.frombuffer(b"a b a c", np.uint8), np.array([0, 7]), lower=True, ends=True, pad=5)
    words, counts = pa.array([b"a ", b"b ", b"c ", b"\n"], pa.large_binary()), np.array([7, 5, 3, 2])
    assert context_tree._WordCounts(words, counts).get(s)[1:].tolist() == [7, 5, 7, 3, 2]
    monkeypatch.setattr(context_tree, "_hashes", lambda data, offsets: np.zeros(len(offsets) - 1, np.int64))
    assert context_tree._WordCounts(words, counts).get(s)[1:].tolist() == [7, 5, 7, 3, 2]
    assert len(key(context_tree.scores(docs))) == 50


def test_byte_run_counts_hold_little():
    """Counts of many parts, beyond 16 bits too, in memory that follows the distinct keys."""
    rng = np.random.default_rng(4)
    pool = np.unique(rng.integers(0, 1 << 48, 600_000))
    counts = context_tree._Counts()
    want = np.zeros(len(pool), np.int64)
    parts = []
    for k in range(60):
        at = np.sort(rng.choice(len(pool), 40_000, replace=False))
        n = rng.integers(0, 9, len(at))
        n[k] = 200_000
        want[at] += n
        parts.append((pool[at], n))
    seen = np.zeros(len(pool), bool)
    for keys, _ in parts:
        seen[np.searchsorted(pool, keys)] = True
    tracemalloc.start()
    try:
        for keys, n in parts:
            counts.add(keys, n)
        got = counts.merge()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(got[0], pool[seen]) and np.array_equal(got[1], want[seen])
    assert peak < 80 * len(pool)
