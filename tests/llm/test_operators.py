"""Each operator against a brute-force version."""

import collections
import hashlib
import itertools
import random
import time
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quarry.llm import (bpe, bytescan, edit_pairs, fingerprints, groups, line_crf, line_dedup, mixing, ngram_join, pii, quality_rules,
                        sharding, toxicity)
from quarry.llm.common import table

from .helpers import SCHEMA, crc_fold, edge_docs, prose, shingle_set, words

SF_SMALL, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def small(spark, name="documents"):
    return table(spark, SF_SMALL, name)


# 1 ------------------------------------------------------------------------------------

def base_counts(text):
    text = text or ""
    w = words(text)
    seen = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    hit = {p for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


@pytest.mark.parametrize("make", [small, edge_docs])
def test_quality_counts(spark, make):
    docs = make(spark)
    want = collections.Counter((r["doc_id"], *base_counts(r["text"])) for r in docs.collect())
    got = quality_rules.query(docs).collect()
    assert want == collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"],
                                        r["n_dup_lines"], r["n_repeat_words"]) for r in got)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["p_good"] >= 0.5)


def test_quality_rates_against_plain_expectation_maximisation(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        good = rng.random() < 0.8
        rows.append(tuple(-1 if rng.random() < 0.3 else int((rng.random() < acc) == good) for acc in (0.9, 0.8, 0.7)))
    names = ["a", "b", "c"]
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    got = quality_rules.fit(quality_rules.patterns(frame, names), names, rounds=15, tolerance=0)
    g, obj = 0.8, [(0.05, 0.7)] * 3
    for _ in range(15):
        post = []
        for r in rows:
            p, q = g, 1 - g
            for v, (x, y) in zip(r, obj):
                if v >= 0:
                    p, q = p * (x if v == 0 else 1 - x), q * (y if v == 0 else 1 - y)
            post.append(p / (p + q))
        g = sum(post) / len(rows)
        new = []
        for i in range(3):
            bad = [(p, 1 - p) for p, r in zip(post, rows) if r[i] == 0]
            voted = [(p, 1 - p) for p, r in zip(post, rows) if r[i] >= 0]
            pair = tuple((sum(x[k] for x in bad) + 0.1) / (sum(x[k] for x in voted) + 0.2) for k in (0, 1))
            new.append(((len(bad) + 0.1) / (len(voted) + 0.2),) * 2 if pair[0] > pair[1] else pair)
        obj = new
    assert abs(got.good - g) < 1e-9 and np.allclose(got.objects, obj)


def test_quality_against_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_CHECK, "labels").collect()}
    rows = [r for r in quality_rules.query(table(spark, SF_CHECK, "documents")).collect()
            if r["doc_id"] in labels and not r["base_failed"]]
    assert np.mean([r["kept"] == bool(labels[r["doc_id"]]) for r in rows]) > 0.97


def test_variety_does_not_depend_on_length(spark):
    dull, lively = [f"w{k % 12}" for k in range(100)], [f"w{k * k % 997}" for k in range(100)]
    rows = [(k, " ".join(ws * times), None, None, None) for k, (ws, times) in enumerate(
        [(dull, 1), (dull, 300), (lively, 1), (lively, 300)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r["vote_variety"] for r in quality_rules.query(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}
    text = " ".join(f"x{k % 37}" for k in range(250))
    w = text.split()
    want = sum(len(set(w[k:k + 100])) for k in range(0, 250, 100))
    one = quality_rules.counts(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string"))
    assert {r["doc_id"]: r["n_block_distinct"] for r in one.collect()} == {1: want, 2: 0, 3: 0}


# 2 ------------------------------------------------------------------------------------

@pytest.mark.parametrize("rows_per_range", [1500, 7])
def test_next_document_and_edited_text(spark, rows_per_range):
    docs = small(spark)
    texts = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id", ascending=False).collect()]
    rows = {r["doc_id"]: r for r in fingerprints.with_next(docs, {}, rows_per_range).collect()}
    assert len(rows) == len(texts)
    for k, (i, _) in enumerate(texts):
        assert rows[i]["_next_t"] == texts[(k + 1) % len(texts)][1]
    for r in fingerprints.query(docs).collect():
        k = [i for i, _ in texts].index(r["doc_id"])
        t, n = texts[k][1], texts[(k + 1) % len(texts)][1]
        assert r["edited_sha256"] == hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest()


def test_fingerprints_estimate_containment(spark):
    a, b = prose(1, 4000), prose(2, 4000)
    docs = spark.createDataFrame([(1, a, b), (2, a, a + " " + b), (3, " ".join(a.split()[:1000]), a), (4, "", ""),
                                  (5, "x", "")], "i int, a string, b string")
    rows = docs.select("i", fingerprints.sketch(docs["a"]).alias("x"), fingerprints.sketch(docs["b"]).alias("y"))
    got = {r["i"]: r for r in rows.select("i", fingerprints.containment(rows["x"], rows["y"]).alias("c"),
                                          fingerprints.merge(rows["x"], rows["y"]).alias("m"), "x", "y").collect()}
    assert got[2]["c"] == 1.0 and got[3]["c"] == 1.0 and got[4]["c"] == 1.0 and got[5]["c"] == 0.0
    exact = len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a))
    assert abs(got[1]["c"] - exact) < 0.1
    assert set(got[1]["m"]) == set(got[1]["x"]) | set(got[1]["y"])


# 3 ------------------------------------------------------------------------------------

@pytest.mark.parametrize("rows_per_bucket", [4096, 9])
def test_shards(spark, rows_per_bucket):
    docs = small(spark)
    rows = sharding.assign(docs, rows_per_bucket=rows_per_bucket).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    slots = collections.defaultdict(list)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]))
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.assign(docs.repartition(5), rows_per_bucket=rows_per_bucket).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_shuffle_is_uniform(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same' AS text")
    rows = sharding.shuffled(docs.selectExpr("doc_id", "8L AS size"), ["doc_id", "size"], rows_per_bucket=100).collect()
    pos = np.array([r["_pos"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    assert sorted(pos.tolist()) == list(range(3000))
    assert abs(np.corrcoef(pos, np.arange(3000))[0, 1]) < 0.08


def test_written_shards_hold_all_rows(spark, scratch):
    docs = edge_docs(spark)
    sharding.write_shards(docs, f"{scratch}/out", shards=3)
    back = spark.read.parquet(f"{scratch}/out")
    assert sorted(map(repr, docs.collect())) == sorted(repr(r["_row"]) for r in back.collect())


@pytest.mark.parametrize("group", [3, 4096])
def test_offsets_are_running_sums(spark, group):
    sizes = [(b, (b * 7) % 11) for b in range(40) if b % 9]
    got = sharding._running(spark.createDataFrame(sizes, "_bucket int, _size bigint"), group).collect()
    assert {r["_bucket"]: r["_first"] for r in got} == {
        b: sum(n for c, n in sizes if c < b) for b, _ in sizes}


def test_a_shard_is_written_by_several_tasks(spark, scratch):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    sharding.write_shards(docs, f"{scratch}/out", shards=2, rows_per_file=30)
    rows = spark.read.parquet(f"{scratch}/out").selectExpr(
        "shard", "slot", "_row.doc_id AS doc_id", "_metadata.file_path AS file", "_metadata.row_index AS at").collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(400))
    places = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign(docs, 2).collect()}
    assert places == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    files = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["file"], r["at"])):
        files[r["shard"], r["file"]].append(r["slot"])
    assert all(s == sorted(s) for s in files.values())
    assert all(sum(shard == k for shard, _ in files) > 2 for k in (0, 1))


# 4 ------------------------------------------------------------------------------------

def plain_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_automaton_finds_what_the_distance_allows():
    entries = sorted(["exact=", "idiot", "moron", "scum", "worthless", "chlla*", "aaaab", "abab*"])
    m, rng = toxicity.Matcher(entries), random.Random(0)
    for _ in range(4000):
        e = rng.choice(entries).rstrip("*=")
        w = "".join("" if rng.random() < 0.1 else c + ("x" if rng.random() < 0.1 else "") for c in e) + rng.choice(["", "s"])
        want = None
        for k, e in enumerate(entries):
            d = (0 if w.startswith(e[:-1]) else 99) if e[-1] == "*" else plain_distance(w, e.rstrip("="))
            if d <= toxicity.allowed_edits(e):
                want = min(want or (d, k), (d, k))
        assert m.match(w) == (want and (want[0], entries[want[1]])), w


def test_quotation_counts_less():
    at = lambda t: toxicity.quoted_weight(t, t.index("idiot"), t.index("idiot") + 5)
    assert at("she wrote that the word \"idiot\" is rude") < at("he is \"an idiot\" maybe") < 1.0
    assert at("you idiot go away") == at("what an idiot") == 1.0


def test_toxicity_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_CHECK, "labels").collect()}
    rows = toxicity.query(table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")).collect()
    assert all(r["held_out"] == (crc_fold(r["doc_id"]) == 1) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


# 5 ------------------------------------------------------------------------------------

def test_schedule_keeps_every_source_within_a_block():
    slots = mixing.slots_of({"a": 5.0, "b": 2.5, "c": 0.01, "d": 1.7}, 60)
    got = mixing.schedule(slots)
    period = sum(slots.values())
    assert sorted(t for s in got.values() for t in s) == list(range(period))
    for s, times in got.items():
        for t in range(period + 1):
            assert abs(sum(x < t for x in times) - t * slots[s] / period) < 1
        for k, t in enumerate(times, 1):
            assert (k - 1) * period // slots[s] <= t < -(-k * period // slots[s])


def test_mix(spark):
    docs = small(spark)
    rows = mixing.query(docs).collect()
    assert sorted((r["doc_id"], r["source"]) for r in rows) == sorted((r["doc_id"], r["source"]) for r in docs.collect())
    by = collections.defaultdict(list)
    for r in rows:
        assert r["release"] <= r["slot"] < r["deadline"] and r["block"] == r["source_rank"] // mixing.BLOCK + 1
        by[r["source"]].append(r["source_rank"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    ordered = [r["doc_id"] for r in mixing.stage(docs).collect()]
    place = {r["doc_id"]: (r["slot"], r["source_rank"]) for r in rows}
    assert sorted(ordered) == sorted(place)
    assert len({place[i][0] for i in ordered}) > 1


@pytest.mark.parametrize("weights", [{"a": 1, "b": 2}, {"a": 1.0, "b": 1e-5, "c": 0.3}, {"a": 2**0.5, "b": 3**0.5}])
def test_blocks_keep_to_the_given_weights_however_long_the_run(weights):
    total = sum(map(Fraction, weights.values()))
    share = {s: Fraction(w) / total for s, w in weights.items()}
    seen = dict.fromkeys(weights, 0)
    for s, t, release, deadline in mixing.timetable(weights, dict.fromkeys(weights, 10**9)):
        seen[s] += 1
        assert release <= t < deadline
        assert all(abs(seen[x] - (t + 1) * share[x]) < 1 for x in share)
        if t == 20_000:
            break
    assert sum(seen.values()) == 20_001


@pytest.mark.parametrize("piece", [mixing.PIECE, 100])
def test_mix_keeps_to_the_given_weights(spark, piece):
    docs = spark.range(9000).selectExpr("id AS doc_id", "'x' AS text", "if(id < 3000, 'a', 'b') AS source")
    rows = mixing.interleave(docs, {"a": 1, "b": 2}, block=1, chunk=64, piece=piece).collect()
    assert len(rows) == 9000 and {r["_slot"] for r in rows} == set(range(9000))
    seen = 0
    for r in sorted(rows, key=lambda r: r["_slot"]):
        seen += r["_src"] == "+a"
        assert abs(3 * seen - (r["_slot"] + 1)) < 3


def test_weights_must_be_above_zero(spark):
    with pytest.raises(ValueError, match="above 0"):
        mixing.interleave(small(spark), {"src1": 0.0})


# 6 ------------------------------------------------------------------------------------

def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    moves, unary = rng.normal(size=(2, 2)), rng.normal(size=5)
    weight = {}
    for code in range(32):
        y = [(code >> k) & 1 for k in range(5)]
        weight[tuple(y)] = np.exp(sum(u for u, v in zip(unary, y) if v) + sum(moves[a, b] for a, b in zip(y, y[1:])))
    total = sum(weight.values())
    want = [sum(w for y, w in weight.items() if y[k]) / total for k in range(5)]
    p, counts, z = line_crf.chain(unary[None, :], np.array([5]), moves)
    assert np.allclose(p[0], want) and np.isclose(z[0], np.log(total)) and np.isclose(counts.sum(), 4)


def test_line_values_are_shares_of_the_characters():
    rng = random.Random(5)
    for _ in range(300):
        line = "".join(rng.choice("aB cé日#$!?;0189\U0001f600 ") for _ in range(rng.randrange(1, 40)))
        if not words(line):
            continue
        got = dict(zip(line_crf._STEPS, line_crf.line_values([line])[0]))
        for name, chars in (("symbols", line_crf._SYMBOLS), ("marks", line_crf._MARKS), ("digits", "0123456789")):
            assert got[name] == sum(c in chars for c in line) / len(line)


def test_marginals_are_weighted_by_line_length():
    crf = line_crf.Crf(np.random.default_rng(4).normal(size=line_crf.WIDTH + 1), np.zeros((2, 2)))
    crf.weights[-1] = 0.0
    lines = ["a " * 50, "### $$$", "some words of no weight"]
    p = crf.marginals(line_crf.active(line_crf.line_values(lines)))
    size = [len(x) for x in lines]
    want = sum(a * b for a, b in zip(p, size)) / sum(size)
    assert np.isclose(crf.average("\n".join(lines)), want) and not np.isclose(want, p.mean())


def test_the_slope_is_fitted_on_the_weighted_average(spark, monkeypatch):
    seen = []
    weighted = line_crf.Crf.weighted
    monkeypatch.setattr(line_crf.Crf, "weighted", lambda s, a, n: seen.append(n.tolist()) or weighted(s, a, n))
    docs = spark.createDataFrame([(k, "good words here\nmore of them" if k % 2 else "# #\n$$$$ $$$$$$") for k in range(60)],
                                 "doc_id bigint, text string")
    line_crf.fit(docs, spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id bigint, quality int, toxic int"))
    assert {tuple(x) for x in seen} == {(15, 12), (3, 11)}


def test_quality_crf_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_CHECK, "labels").collect()}
    rows = line_crf.query(table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


# 7 ------------------------------------------------------------------------------------

def test_edit_distance():
    rng = random.Random(1)
    for _ in range(1000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == plain_distance(a, b)


def test_line_groups(spark):
    base = prose(11, 900)
    near = base.replace("river", "rivers", 1)
    docs = spark.createDataFrame([
        (1, f"{base}\nHello\n\nonly here one two three four", "", "", 1), (2, f"{near}\nhello\nhello", "", "", 1),
        (3, f"{base.upper()}", "", "", 1), (4, "something else\n" + prose(12, 80), "", "", 1)], SCHEMA)
    got = {r["doc_id"]: (r["n_lines"], r["n_kept"], r["dropped_lines"]) for r in line_dedup.query(docs).collect()}
    assert got == {1: (3, 3, ""), 2: (3, 0, "0,1,2"), 3: (1, 0, "0"), 4: (2, 2, "")}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.stage(docs).collect()}
    assert set(kept) == {1, 4} and kept[1].count("\n") == 3


def test_equal_lines_against_brute_force(spark):
    docs = table(spark, SF_CHECK, "documents")
    norm = lambda x: " ".join(x.lower().split())
    places, lines = collections.defaultdict(list), {}
    for r in docs.collect():
        for k, x in enumerate((r["text"] or "").split("\n")):
            if x.split():
                places[norm(x)].append((r["doc_id"], k))
                lines[r["doc_id"], k] = norm(x)
    got = {(r["doc_id"], int(k)) for r in line_dedup.query(docs).collect() if r["dropped_lines"]
           for k in r["dropped_lines"].split(",")}
    equal = {p for ps in places.values() for p in sorted(ps)[1:]}
    assert equal <= got
    # what else goes has a similar line that stays, or that goes for another one
    rest = got - equal
    big = [x for x in places if len(x.split()) >= line_dedup.MIN_WORDS]
    for p in sorted(rest)[:40]:
        assert any(x != lines[p] and line_dedup.similar(x, lines[p]) for x in big)


def test_segments_leave_no_short_pair_out():
    rng = random.Random(2)
    for _ in range(20_000):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 31)))
        b = list(a)
        for _ in range(rng.randrange(1, 7)):
            k = rng.randrange(len(b) + 1)
            b[k:k + rng.randrange(2)] = rng.choice(["", "a", "b", "c"])
        x, y = sorted((a, "".join(b)), key=len)
        if x != y and 0 < len(x) <= line_dedup.SHORT and line_dedup.similar(x, y):
            assert not line_dedup.other_keys(x).isdisjoint(line_dedup.own_keys(y))


def test_short_lines_are_compared(spark):
    docs = spark.createDataFrame([(1, "All rights reserved.\nhello", "", "", 1), (2, "all right reserved.\nhullo", "", "", 1),
                                  (3, "hippo", "", "", 1)], SCHEMA)
    got = {r["doc_id"]: r["dropped_lines"] for r in line_dedup.query(docs).collect()}
    assert got == {1: "", 2: "0,1", 3: ""}


def test_recall_of_near_lines_against_all_pairs(spark):
    """Of the lines that only similarity removes, by brute force over all
    pairs, nearly all go; none else does."""
    docs = table(spark, SF_CHECK, "documents").where("doc_id < 400")
    first = {}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        for k, x in enumerate((r["text"] or "").split("\n")):
            if x.split():
                first.setdefault(" ".join(x.lower().split()), (r["doc_id"], k))
    lines = sorted(first, key=len)
    sizes, grams, root = np.array([len(x) for x in lines]), line_dedup._bigrams(lines).astype(np.int16), {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x
    for i, x in enumerate(lines):
        near = np.arange(i + 1, np.searchsorted(sizes, sizes[i] / line_dedup.SIMILARITY + 1e-9, side="right"))
        apart = np.abs(grams[near] - grams[i]).sum(axis=1, dtype=np.int64)
        for j in near[apart <= 4 * (1 - line_dedup.SIMILARITY) * sizes[near] + 1e-6].tolist():
            if line_dedup.similar(x, lines[j]):
                p, q = find(first[x]), find(first[lines[j]])
                root[max(p, q)] = min(p, q)
    want = {p for p in first.values() if find(p) != p}
    got = {(r["doc_id"], int(k)) for r in line_dedup.query(docs).collect() if r["dropped_lines"]
           for k in r["dropped_lines"].split(",")} & set(first.values())
    assert got <= want and len(got) >= 0.95 * len(want), (len(got), len(want))


def test_components_and_blocks(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    comps = groups.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert {r["id"]: r["comp"] for r in comps.collect()} == {x: find(x) for x in nodes}
    one = spark.range(50).selectExpr("id", "0L AS comp")
    rows = groups.blocks(one, 10).collect()
    per = collections.defaultdict(list)
    for r in rows:
        per[r["block"]].append(r)
    counted = collections.Counter()
    for block, members in per.items():
        home = groups.home(np.array([r["part"] for r in members]), members[0]["parts"], block)
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                if a["part"] != b["part"] or home[i]:
                    counted[min(a["id"], b["id"]), max(a["id"], b["id"])] += 1
    assert len(counted) == 50 * 49 // 2 and set(counted.values()) == {1}


def test_large_buckets_are_compared_part_by_part(spark):
    rows = spark.range(60).selectExpr("7L AS key", "id", "shiftleft(1L, cast(id % 60 as int)) AS b")
    edges = groups.bucket_edges(rows, ["b"], 2, bucket_rows=8)
    assert groups.components(edges).selectExpr("count(*)", "count(distinct comp)").first() == (60, 1)


# 8 ------------------------------------------------------------------------------------

def test_base_spans_are_the_patterns(spark):
    rng = random.Random(3)
    texts = [r["text"] for r in small(spark).collect()]
    texts += ["".join(rng.choice("ab.@-+ 01234567 89()._%é") for _ in range(rng.randrange(60))) for _ in range(5000)]
    for t in texts:
        want = [(k, *m.span()) for k in pii.KINDS for m in pii.PATTERNS[k].finditer(t) if pii._holds(k, m.group())]
        assert pii.base_spans(t) == want


def test_added_spans(spark):
    model = pii.fit(table(spark, SF_CHECK, "documents"))
    found = lambda t: [(k, t[a:b]) for k, a, b in model.spans(t)[1]]
    assert found("write to john.smith at example dot com now") == [("email", "john.smith at example dot com")]
    assert found("ring (555) 123-4567 today") == [("phone", "(555) 123-4567")]
    assert found("Version 2.0.1 of 2024-01-02") == []
    base, spans = model.spans("me@x.org and 4111 1111 1111 1111 or 300.1.1.1")
    assert [k for k, _, _ in base] == ["email", "card"] and set(base) <= set(spans)


def planted_spans():
    """Spans written as the patterns do not have them, with their kinds."""
    names = ["john.smith", "anna", "k_meyer9", "li-wei", "info"]
    hosts = ["example.com", "mail.example.org", "mx1.mail.example.co.uk", "uni-ulm.de"]
    for k, (name, host) in enumerate((n, h) for n in names for h in hosts):
        yield "email", f"{name} at {host.replace('.', ' dot ')}"
        yield "email", f"{name} [at] {host.replace('.', ' [dot] ')}"
        yield "email", f"{name} (at) {host}"
        a, b, c = 201 + 7 * k, 310 + 11 * k, 1000 + 397 * k
        yield "phone", f"({a}) {b}-{c}"
        yield "phone", f"{a}-{b}-{c}"
        yield "ip", f"{10 + k}[.]{20 + k}[.]{3 * k}[.]{k + 1}"
        digits = f"4{a}{b}{c}{k:02}55"[:15]
        digits += next(d for d in "0123456789" if pii.luhn(digits + d))
        yield "card", ".".join(digits[i:i + 4] for i in range(0, 16, 4))


def test_recall_of_planted_rewritten_spans(spark):
    model = pii.fit(table(spark, SF_CHECK, "documents"))
    found, all_of = collections.Counter(), collections.Counter()
    for kind, s in planted_spans():
        before, after = prose(7, 12), prose(8, 12)
        text = f"{before} {s} {after}"
        assert all(k != kind or text[a:b] != s for k, a, b in pii.base_spans(text))
        all_of[kind] += 1
        found[kind] += (kind, len(before) + 1, len(before) + 1 + len(s)) in model.spans(text)[1]
    assert all(found[k] >= 0.9 * n for k, n in all_of.items()), (found, all_of)
    clean = ["they met at home. There are copies", "that and. 12345678 of it", "Version 2.0.1 of 2024-01-02",
             "from 1914-1918 and 1939-1945", "it cost 1.250.000 or 12,500.00 at most", "at dot dot dot"]
    assert [model.spans(t)[1] for t in clean] == [[]] * len(clean)


def test_sample_is_bounded_and_counts_copies_once(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'copy 1234', concat('text ', id + 10000)) AS text")
    every = pii.sample_texts(docs, 5000).collect()
    assert len(every) == 4001 and len({r["text"] for r in every}) == 4001
    some = pii.sample_texts(docs, 50).collect()
    assert [tuple(r) for r in some] == sorted(tuple(r) for r in every)[:50]


def test_segmentations_against_all():
    text = "a 12345 678901 b"
    lat = pii.lattice(text, 0, len(text))
    model = pii.SemiCrf(np.random.default_rng(2).normal(size=(len(pii.KINDS), len(pii.FEATURES))))
    s = model.scores(lat)

    def paths(at, n):
        if at == n:
            yield 0.0, []
            return
        for v, p in paths(at + 1, n):
            yield v, p
        for c, (i, j) in enumerate(lat.spans):
            if i == at:
                for v, p in paths(j, n):
                    for k in range(len(pii.KINDS)):
                        yield v + s[c, k], [(pii.KINDS[k], lat.places[i], lat.places[j])] + p
    every = list(paths(0, len(lat.places) - 1))
    fwd, bwd, _ = pii._paths(lat, s)
    assert np.isclose(fwd[-1], np.logaddexp.reduce([v for v, _ in every])) and np.isclose(fwd[-1], bwd[0])
    assert model.best(lat) == max(every, key=lambda x: x[0])[1]


# 9 ------------------------------------------------------------------------------------

def test_tokens_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.word_tokenizer_path()
    mine, ref = bpe.Tokenizer(path), tokenizers.Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = [r["text"] for r in small(spark).collect()]
    texts += ["Hello  World's 123 don't!! <|startoftext|> x<|endoftext|>y İstanbul ﬁ é ñ́ …!!! a_b 日本 ΣΑΣ", "", "aaaaaaa"]
    texts += ["".join(rng.choice("aabcdehinorst' -é日😀") for _ in range(rng.randrange(60))) for _ in range(1000)]
    for t in texts:
        ids = ref.encode(t, add_special_tokens=False).ids
        assert mine.encode(t) == ids and mine.decode(ids) == ref.decode(ids, skip_special_tokens=False)
    for r in bpe.query(small(spark)).collect():
        t = next(x["text"] for x in small(spark).where(f"doc_id = {r['doc_id']}").collect()) if r["doc_id"] < 5 else None
        if t is not None:
            ids = ref.encode(t, add_special_tokens=False).ids
            assert r["n_tokens"] == len(ids)
            assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(
                ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_automaton_is_the_merge_procedure():
    rng = random.Random(4)
    for _ in range(60):
        tokens, merges = list("ab"), []
        for _ in range(8):
            pair = (rng.choice(tokens), rng.choice(tokens))
            if pair not in merges and "".join(pair) not in tokens:
                merges.append(pair)
                tokens.append("".join(pair))
        auto = bpe.Automaton(list("ab"), merges)
        trie = auto.trie("")
        for _ in range(40):
            word = "".join(rng.choice("ab") for _ in range(1 + rng.randrange(12)))
            want = list(word)
            for u, v in merges:
                out, k = [], 0
                while k < len(want):
                    if want[k:k + 2] == [u, v]:
                        out.append(u + v)
                        k += 2
                    else:
                        out.append(want[k])
                        k += 1
                want = out
            assert [auto.tokens[t] for t in auto.path(word, trie, 1)] == want, (merges, word)


# 10 -----------------------------------------------------------------------------------

def brute_links(rows):
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(n):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return collections.Counter((rows[i][0], least[find(i)], links[i]) for i in range(n))


@pytest.mark.parametrize("block_docs", [512, 6])
def test_links_against_brute_force(spark, monkeypatch, block_docs):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block_docs)
    rows = [(r["doc_id"], r["text"]) for r in small(spark).collect()]
    base = prose(17, 300).split()
    rng = random.Random(6)
    for k in range(25):      # a group of near copies
        w = list(base)
        for _ in range(rng.randrange(12)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(9999)}"
        rows.append((1000 + k, " ".join(w)))
    rows += [(2000, ""), (2001, " "), (2002, "a b"), (2003, "a  b"), (2004, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], SCHEMA)
    got = collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.query(docs).collect())
    assert got == brute_links(rows)
    kept = sorted(r["doc_id"] for r in ngram_join.stage(docs).collect())
    assert kept == sorted({c for _, c, _ in got})


def test_pruning_keeps_likely_pairs():
    for n in (16, 96):
        m = ngram_join.least_matches(n, 0.8)
        assert 0 < m < 0.8 * n


def test_edit_distance_up_to_a_bound():
    rng = random.Random(12)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(14)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(14)))
        d, most = line_dedup.edit_distance(a, b), rng.randrange(8)
        assert (line_dedup.edit_distance(a, b, most) <= most) == (d <= most)
        if d <= most:
            assert line_dedup.edit_distance(a, b, most) == d


def test_groups_of_every_size_give_their_near_pairs(spark):
    rng = random.Random(13)
    rows = [(k, 1000 * k + i, rng.choice([0, 1, 255, rng.randrange(1 << 62)])) for k in range(60) for i in range(rng.choice([1, 2, 3, 5, 31, 40]))]
    got = groups.components(groups.bucket_edges(spark.createDataFrame(rows, "key bigint, id bigint, b bigint"), ["b"], 2))
    want = {}
    for k in range(60):
        own = [(i, b) for key, i, b in rows if key == k]
        for i, b in own:
            near = [j for j, c in own if bin(b ^ c).count("1") <= 2]
            if len(near) > 1:
                want[i] = min(near)
    assert {r["id"]: r["comp"] for r in got.collect()} == want


def test_kept_prefixes_change_no_token(monkeypatch):
    """Words that begin alike, up to a long one, with few prefixes kept at once."""
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.word_tokenizer_path()
    mine, ref = bpe.Tokenizer(path), tokenizers.Tokenizer.from_file(path)
    ref.no_padding()
    ref.no_truncation()
    rng = random.Random(6)
    begins = ["".join(rng.choice("aeinrst") for _ in range(n)) for n in (3, 4, 5, 8, 9, 16, 17, 40)] + ["éçan", "x" * 3000]
    monkeypatch.setattr(bpe, "PREFIXES", 40)
    for _ in range(600):
        b = rng.choice(begins)
        word = b[:rng.randrange(1, len(b) + 1)] + "".join(rng.choice("aeinrsté") for _ in range(rng.randrange(8)))
        assert mine.encode(word) == ref.encode(word, add_special_tokens=False).ids
    kept = mine._trie[3]
    assert 0 < len(kept) <= 40 and max(map(len, kept)) <= bpe.LONGEST


def test_edit_distances_of_many_pairs_at_once(monkeypatch):
    """Equal to the plain ones, also beyond the bounds that fit in a byte and
    those that are taken one pair at a time."""
    rng = random.Random(12)
    texts = ["", "", "a", "ab"]
    for n in [3, 10, 30, 70, 70, 150] * 8 + [400] * 4:
        x = [rng.choice("abcé") for _ in range(n)]
        texts.append("".join(x))
        for _ in range(rng.randrange(n // 2 + 1)):
            k = rng.randrange(len(x) + 1)
            x[k:k + rng.randrange(2)] = rng.choice(["", "a", "x", "bx"])
        texts.append("".join(x))
    lines = edit_pairs.Texts(texts)
    pairs = [(k, k + 1) for k in range(0, len(texts), 2)] + [(rng.randrange(len(texts)), rng.randrange(len(texts))) for _ in range(300)]
    i, j = (np.array(x) for x in zip(*pairs))
    most = np.array([rng.randrange(len(texts[a]) // 2 + 3) for a, _ in pairs])
    want = [line_dedup.edit_distance(texts[a], texts[b]) <= k for (a, b), k in zip(pairs, most.tolist())]
    assert 20 < sum(want) < len(want) - 20
    for small, wide in ((245, 1000), (8, 1000), (8, 30)):
        monkeypatch.setattr(edit_pairs, "SMALL", small)
        monkeypatch.setattr(edit_pairs, "WIDE", wide)
        assert lines.within(i, j, most).tolist() == want


def test_bounds_of_several_words_are_exact():
    """Long pairs, with distances about the bound and about what fits in a word,
    taken many at once and one at a time; what the work grows with is the columns."""
    rng = random.Random(14)
    texts, most = [], []
    for n in (64, 200, 330, 330, 700, 1300) * 40:
        x = [rng.choice("abcdeé ") for _ in range(n)]
        texts.append("".join(x))
        for _ in range(rng.choice([1, 3, n // 20, n // 6])):
            k = rng.randrange(len(x) + 1)
            x[k:k + rng.randrange(3)] = rng.choice(["", "a", "bx", "é"])
        texts.append("".join(x))
        d = line_dedup.edit_distance(*texts[-2:])
        most.append(max(0, rng.choice([d - 1, d, d + 1, 63, 64, 127, 128, n // 5])))
    lines, i = edit_pairs.Texts(texts), np.arange(0, len(texts), 2)
    want = [line_dedup.edit_distance(texts[a], texts[a + 1]) <= k for a, k in zip(i.tolist(), most)]
    assert 20 < sum(want) < len(want) - 20
    assert lines.within(i, i + 1, np.array(most)).tolist() == want
    assert [edit_pairs.within_one(texts[a + 1], texts[a], k) for a, k in zip(i.tolist(), most)] == want


def test_mixed_hashes_of_any_shape_are_those_of_each_number(monkeypatch):
    x = np.arange(60, dtype=np.uint64).reshape(12, 5) * np.uint64(0x9E3779B97F4A7C15)
    want = [[int(bytescan.mix(np.array([v]))[0]) for v in row] for row in x]
    monkeypatch.setattr(bytescan, "MIXED", 7)
    assert bytescan.mix(x).tolist() == want and bytescan.mix(x.T).T.tolist() == want
    assert len({v for row in want for v in row}) == 60 and bytescan.mix(x[:0]).shape == (0, 5)


def test_line_buckets_hold_no_more_marks_than_needed(spark, monkeypatch):
    """Of three equal marks one is among any six: a line comes under six of its
    eight, unless it lacks one; pairs with just three equal marks are still found."""
    seen = []
    bucket_edges = groups.bucket_edges
    monkeypatch.setattr(groups, "bucket_edges", lambda rows, *rest: seen.append(rows) or bucket_edges(rows, *rest))
    rng = random.Random(15)
    lines = [" ".join("".join(rng.choice("aeinrst") for _ in range(7)) for _ in range(40)) for _ in range(30)]
    near = [x[:150] + "".join(rng.choice("aeinrst") for _ in range(40)) + x[190:] for x in lines]
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(lines + near)], "doc_id bigint, text string")
    dropped = [r["doc_id"] for r in line_dedup.query(docs).where("n_kept = 0").collect()]
    found = {(int(k) - 30) for k in dropped}
    rows = seen[0].selectExpr("id", "pmod(key, 8) AS k").collect()
    assert len(rows) == 6 * 60 and {r["k"] for r in rows} == set(range(6))
    buffer = "\n".join(lines + near).encode()
    data = np.frombuffer(buffer.replace(b"\n", b" ") + b" ", np.uint8)
    size = [len(x) + 1 for x in lines + near]
    sim, marks, sketch = line_dedup.signatures(data, np.repeat(np.arange(60), size), 60)
    bits = np.stack([sim, sketch], axis=1)
    same = (marks[:30] == marks[30:]).sum(axis=1)
    want = {k for k in range(30) if same[k] >= line_dedup.SAME and line_dedup.alike(bits[k], bits[30 + k])
            and line_dedup.similar(lines[k], near[k])}
    assert want and want <= found


def test_lines_around_one_passage_take_no_time_each():
    """A block of long lines that share half of their text and are not similar:
    each pair once took a millisecond, half a minute together."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(6))       # noqa: E731
    passage = " ".join(word() for _ in range(45))
    texts = []
    for _ in range(250):
        around = [word() for _ in range(45)]
        k = rng.randrange(5, 40)
        texts.append(" ".join([*around[:k], passage, *around[k:]]))
    texts += [texts[0] + " x", "y " + texts[0]]
    began = time.process_time()
    a, b = line_dedup._linked(np.arange(len(texts)), texts, np.array([0]),
                              lambda i, j: np.ones(np.broadcast_shapes(i.shape, j.shape), dtype=bool))
    assert time.process_time() - began < 8
    assert {*a.tolist(), *b.tolist()} == {0, 250, 251} and len(a) == 2


def test_line_signatures_equal_plain_ones():
    """SimHash and marks of lines, also very long ones, as counted bit by bit."""
    rng = np.random.default_rng(8)
    mask = (1 << 64) - 1

    def mix(x):
        x ^= x >> 32
        for _ in range(2):
            x = x * 0xD6E8FEB86659FD93 & mask
            x ^= x >> 32
        return x

    lines = [b"", b"abc", b"abcd", b"abcdefghi", b"abcdefghij", bytes(rng.integers(97, 123, 3000).astype(np.uint8))]
    lines += [bytes(rng.integers(97, 100, k).astype(np.uint8)) for k in range(1, 40)]
    data = np.frombuffer(b"".join(lines), np.uint8)
    sim, marks, sketch = line_dedup.signatures(data, np.repeat(np.arange(len(lines)), [len(x) for x in lines]), len(lines))
    for k, x in enumerate(lines):
        four = {mix(int.from_bytes(x[i:i + 4], "little") * 0x9E3779B97F4A7C15 & mask) for i in range(len(x) - 3)}
        some = {mix(h >> 20) for h in four if h & 3 == 0}
        bits = [sum(h.to_bytes(8, "little")[j // 8] >> (7 - j % 8) & 1 for h in some) * 2 > len(some) for j in range(64)]
        assert int(sim[k]) == int.from_bytes(np.packbits(bits).tobytes(), "little")
        least = {}
        for i in range(len(x) - 9):
            h = mix(mix(int.from_bytes(x[i:i + 8], "little")) + int.from_bytes(x[i + 6:i + 10], "little") * 0xC2B2AE3D27D4EB4F & mask)
            least[h >> 61] = min(least.get(h >> 61, mask), h)
        want = [least[j] >> 20 & 0xFFFFFFFF if j in least else 0 for j in range(8)]
        assert marks[k].tolist() == want
        assert sketch[k:k + 1].view(np.uint8).tolist() == [m & 255 for m in want]
    # more words than a 16-bit counter counts
    words = rng.integers(0, 1 << 64, 70_000, dtype=np.uint64) | np.uint64(1 << 40)
    bounds = np.array([0, 0, 69_990, 70_000])
    got = line_dedup.majority(words, bounds)
    for a, b, x in zip(bounds, bounds[1:], got.tolist()):
        assert [x >> k & 1 for k in range(64)] == [int(2 * int((words[a:b] >> np.uint64(k) & np.uint64(1)).sum()) > b - a) for k in range(64)]


def test_line_candidates_by_words_equal_bytes():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 1 << 64, (300, 2), dtype=np.uint64)
    y = x ^ np.where(rng.random((300, 2)) < 0.9, rng.integers(0, 1 << 64, (300, 2), dtype=np.uint64)
                     & rng.integers(0, 1 << 64, (300, 2), dtype=np.uint64) & rng.integers(0, 1 << 64, (300, 2), dtype=np.uint64), np.uint64(0))
    y[:, 1] ^= np.uint64(0x0100) ^ (rng.integers(0, 256, 300).astype(np.uint64) << np.uint64(56))
    same = ((x[:, 1] ^ y[:, 1])[:, None].view(np.uint8) == 0).sum(axis=1)
    want = (same >= line_dedup.SAME) & (np.bitwise_count(x[:, 0] ^ y[:, 0]) <= line_dedup.BITS_APART)
    assert 0 < want.sum() < 300 and np.array_equal(line_dedup.alike(x, y), want)


def test_bigrams_of_many_lines_take_little_memory():
    """Counted some lines at a time, also lines longer than that and empty ones."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefgh é😀", k=rng.choice((0, 1, 2, 30, 300, 900)))) for _ in range(6000)]
    texts[7] = "xy" * 200_000
    chars = sum(map(len, texts))
    tracemalloc.start()
    try:
        lines = edit_pairs.Texts(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 * chars + 20_000_000
    for k in (0, 7, 8, 2500, 5999):
        want = np.zeros(256, np.int64)
        for a, b in zip(texts[k], texts[k][1:]):
            want[(ord(a) * 31 + ord(b)) % (1 << 32) % 256] += 1
        assert lines.grams[k].tolist() == np.minimum(want, 32000).tolist()


def sketches(rng, n: int, kinds: int) -> list[int]:
    """Words of eight bytes that have few values each, so that many have some in common."""
    return [int.from_bytes(bytes(rng.randrange(kinds) for _ in range(8)), "little", signed=True) for _ in range(n)]


def equal_bytes(x: int, y: int) -> int:
    return sum(a == b for a, b in zip(*(z.to_bytes(8, "little", signed=True) for z in (x, y))))


@pytest.mark.parametrize("bucket_rows", [None, 100])
def test_large_buckets_are_compared_by_bytes_of_their_sketches(spark, bucket_rows):
    """Compared in the task, and dealt out to several before: the near pairs connect the same rows."""
    rng = random.Random(21)
    base = rng.randrange(1 << 62)
    marks = [x & ~0xFFFF | 5 | rng.choice([x & 0xFF00, 256]) for x in sketches(rng, 700, 90)]      # byte 0 is equal, 1 often
    sims = [base ^ sum(1 << b for b in rng.sample(range(62), rng.randrange(4, 28))) for _ in marks]
    rows = [(8 * 77, k, sims[k], marks[k]) for k in range(700)]
    words = np.array([[s, m] for s, m in zip(sims, marks)], dtype=np.int64).view(np.uint64)
    near = line_dedup.alike(words[:, None, :], words[None, :, :])
    got = groups.bucket_edges(spark.createDataFrame(rows, "key bigint, id bigint, sim bigint, sketch bigint"), ["sim", "sketch"],
                              line_dedup.alike, bucket_rows, "sketch", line_dedup.SAME)
    comp = np.arange(700)
    while not np.array_equal(least := np.where(near, comp[None, :], 700).min(axis=1), comp):
        comp = least
    want = {k: int(c) for k, c in enumerate(comp) if (comp == c).sum() > 1}
    assert 100 < len(want) < 700 and {r["id"]: r["comp"] for r in groups.components(got).collect()} == want


def test_large_components_fall_into_blocks_by_bytes(spark):
    """Pairs with three equal bytes meet, in few rows; a component of near copies is
    dealt in pairs of parts still, and one that fits a block is not dealt."""
    rng = random.Random(22)
    rows = [(k, 7, x) for k, x in enumerate(sketches(rng, 900, 24))]
    copies = [(1000 + k, 8, x) for k, x in enumerate([rng.randrange(1 << 60)] * 90)]
    small_ones = [(2000 + k, 9, x) for k, x in enumerate(sketches(rng, 30, 24))]
    schema = "id bigint, comp bigint, sketch bigint"
    got = groups.sketch_blocks(spark.createDataFrame(rows + copies + small_ones, schema), 32, 3).collect()
    assert {r["comp"] for r in got} == {7, 8}
    blocks = collections.defaultdict(set)
    for r in got:
        blocks[r["comp"], r["block"]].add(r["id"])
    meet = {p for b in blocks.values() for p in itertools.combinations(sorted(b), 2)}
    assert {(i, j) for (i, _, x), (j, _, y) in itertools.combinations(rows, 2) if equal_bytes(x, y) >= 3} <= meet
    assert set(itertools.combinations(range(1000, 1090), 2)) <= meet
    # pairs of parts took 56 rows of each: 900 * 2 / 32 parts
    assert max(map(len, blocks.values())) <= 64 and sum(r["comp"] == 7 for r in got) <= 36 * 900
    assert groups.sketch_blocks(spark.createDataFrame(small_ones, schema), 32, 3) is None


def test_lines_of_a_long_chain_are_compared_in_few_blocks(spark, monkeypatch):
    """Every line is near the next ones only, and all make one component: the rows
    that are compared once grew with its square."""
    rng = random.Random(23)
    text = "".join(rng.choice("aeinrst ") for _ in range(12_000))
    docs = spark.createDataFrame([(k, "x" + text[15 * k:15 * k + 300] + "x") for k in range(700)], "doc_id bigint, text string")
    seen = []
    compare_blocks = groups.compare_blocks
    monkeypatch.setattr(groups, "compare_blocks", lambda rows, *rest, **more: seen.append(rows) or compare_blocks(rows, *rest, **more))
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 16)
    kept = [r["doc_id"] for r in line_dedup.query(docs).where("n_kept > 0").collect()]
    assert kept == [0]
    lines = seen[-1].selectExpr("count(*)", "count(distinct id)", "count(distinct comp)").first()
    assert lines[1:] == (700, 1) and lines[0] <= 36 * 700      # in pairs of parts 86 times 700


def test_unlike_lengths_are_no_candidates():
    x = np.array([[5, 5, n] for n in (100, 80, 79, 125, 126, line_dedup.UNKNOWN)], dtype=np.uint64)
    assert line_dedup.alike(x[:1], x).all()
    assert line_dedup.may_link(x[:1], x).tolist() == [True, True, False, True, False, True]
    assert line_dedup.may_link(x, x[:1]).tolist() == [True, True, False, True, False, True]


def test_blocks_without_candidates_have_no_edges():
    none = lambda i, j: np.zeros(np.broadcast_shapes(i.shape, j.shape), dtype=bool)       # noqa: E731
    a, b = edit_pairs.forest(np.arange(19), np.array([0, 3, 10]), none, lambda i, j: np.ones(len(i), dtype=bool))
    assert not len(a) and not len(b)
