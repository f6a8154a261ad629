"""Vocabularies that are tables, and posting lists cut by rank."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_skew import conf
from quarry.operators import term_tables as T
from quarry.sources import bindings as B


@pytest.fixture(scope="module")
def corpus(spark):
    """`common` is in every article; some terms are in none."""
    rng = random.Random(5)
    rows = [(i, f"t{i}", " ".join(["common"] + [f"w{int(rng.paretovariate(0.4)) % 3000}" for _ in range(rng.randrange(30))]))
            for i in range(600)]
    vocab = ["common", "", "nowhere"] + [f"w{i}" for i in range(0, 3000, 3)]
    articles = spark.createDataFrame(rows, "doc_id bigint, title string, text string").repartition(6)
    table = T.vocabulary_table(spark.createDataFrame([(v,) for v in vocab + vocab[:5] + [None]], "term string"))
    hits = {(t, i) for i, _, text in rows for t in text.split(" ") if t in set(vocab) and t}
    return articles, table, hits


def test_rankings(spark, corpus):
    articles, vocab, hits = corpus
    want = collections.Counter(t for t, _ in hits)
    got = [tuple(r) for r in T.rank(articles, vocab).collect()]
    assert got == sorted(want.items(), key=lambda r: (-r[1], r[0]))
    zero = dict(tuple(r) for r in T.rank_zero_filled(articles, vocab).collect())
    assert zero == {t: want[t] for t in ["common", "nowhere"] + [f"w{i}" for i in range(0, 3000, 3)]}


def test_the_filter_lets_all_terms_and_few_others_pass(spark, corpus):
    articles, vocab, hits = corpus
    passed = {r["term"] for r in T.candidates(articles, vocab).collect()}
    terms = {t for t, _ in hits}
    every = {r[0] for r in articles.select(F.explode(F.split("text", " "))).collect()}
    assert terms <= passed
    assert len(passed - terms) <= 0.03 * len(every - terms) + 3
    assert T.bloom_bits(10) == 1024 and T.bloom_bits(100_000) == 1 << 21 and T.bloom_bits(1 << 40) == T.BLOOM_BITS


@pytest.mark.parametrize("hot_terms", [3, 50, 10_000])
def test_index(spark, corpus, hot_terms):
    articles, vocab, hits = corpus
    got = T.inverted_index(articles, vocab, hot_terms=hot_terms)
    assert collections.Counter((r["term"], r["doc_id"]) for r in got.collect()) == collections.Counter(hits)
    assert got.where("title <> concat('t', doc_id)").count() == 0


def test_hot_tokens_are_not_shuffled(spark, corpus):
    """The rows of the shuffle join hold no token above its share of the hits."""
    articles, vocab, hits = corpus
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        got = T.inverted_index(articles, vocab, hot_terms=20)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        assert "isnull(_in" in plan.split("SortMergeJoin [term")[1]
    n = collections.Counter(t for t, _ in hits)
    hot = {t for t, c in n.items() if c > sum(n.values()) // 20 + 1}
    assert "common" in hot and len(hot) <= 20


def test_terms_that_no_article_has_do_not_fill_the_filter(spark, corpus, monkeypatch):
    """Filters hold terms of the articles only, however many others there are."""
    articles, vocab, hits = corpus
    large = vocab.unionByName(spark.range(50_000).selectExpr("concat('line-', id) AS term"))
    sizes, bits = [], T.bloom_bits
    monkeypatch.setattr(T, "bloom_bits", lambda n: sizes.append(n) or bits(n))
    got = T.inverted_index(articles, large, hot_terms=20)
    assert collections.Counter((r["term"], r["doc_id"]) for r in got.collect()) == collections.Counter(hits)
    assert sizes and max(sizes) <= articles.select(F.explode(F.split("text", " ")).alias("t")).distinct().count()


def test_a_vocabulary_of_over_100_000_terms(spark):
    assert B.term_table(spark, "/root/testdata/sf0.01").count() > 100_000


def spread_index(spark, n, span):
    """One term in n articles, another in a few; ids over a wide range."""
    rng = random.Random(9)
    ids = rng.sample(range(-span, span), n)
    rows = [("often", i, str(i)) for i in ids] + [("seldom", i, str(i)) for i in ids[:5]]
    return ids, spark.createDataFrame(rows, "term string, doc_id bigint, title string").repartition(7)


def test_blocks_of_spread_ids_are_even(spark):
    ids, index = spread_index(spark, 5000, 1 << 60)
    with conf(spark, **{"spark.sql.adaptive.enabled": "false"}):      # several ranges
        blocks = T.ranked_blocks(index, block_docs=64)
        rows = blocks.withColumn("ids", T.block_ids(F.col("first_id"), F.col("deltas"))).orderBy("term", "block").collect()
    often = [r for r in rows if r["term"] == "often"]
    sizes = [r["n"] for r in often]
    assert len(often) == 79 and max(sizes) - min(sizes) <= 1 and max(sizes) <= 64
    assert [i for r in often for i in r["ids"]] == sorted(ids)
    assert [r["block"] for r in often] == list(range(79))
    assert all(r["titles"] == [str(i) for i in r["ids"]] and r["deltas"][0] == 0 for r in rows)
    assert [r["n"] for r in rows if r["term"] == "seldom"] == [5]


def test_blocks_of_dense_ids_and_none(spark):
    index = spark.range(1000).selectExpr("'t' AS term", "id AS doc_id", "string(id) AS title")
    rows = T.ranked_blocks(index, block_docs=300).orderBy("block").collect()
    assert [(r["n"], r["first_id"]) for r in rows] == [(250, 0), (250, 250), (250, 500), (250, 750)]
    assert T.ranked_blocks(index.where("false")).collect() == []
    with pytest.raises(ValueError):
        T.ranked_blocks(index, block_docs=0)


def test_ranked_blocks_hold_the_plain_blocks_hits(spark):
    from quarry.operators import terms
    index = terms.inverted_index(B.articles(spark, SF_SMALL), B.DOC_TERMS)
    n = {r["term"]: r["n"] for r in T.ranked_blocks(index).groupBy("term").agg(F.sum("n").alias("n")).collect()}
    assert n == {r["term"]: r["n"] for r in terms.rank_from_index(terms.index_blocks(index)).collect()}
