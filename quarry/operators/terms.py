"""Term ranking over articles: document counts per vocabulary term, a
zero-filled ranking, an inverted index and a ranking from that index.

Plan shape: one scan of the text, tokens intersected with the vocabulary in
the row (small vocabulary) or matched by a broadcast hash join on distinct
tokens (large vocabulary; the vocabulary is a parameter, so its size is known
on the driver). The one-pass ranking and the index then `explode`, and the
ranking counts with a partial + final `count` per term: only (term, partial
count) pairs cross the shuffle, so a term present in every document costs no
more than any other. The zero-filled counts are a single global aggregate of
one conditional count per term (one row per task crosses the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import trunc_div
from quarry.functions.text import mentions, tokens, vocabulary_hits
from quarry import params
from quarry.params import LITERAL_VOCAB_MAX, Vocabulary

# Documents per posting-list block of the grouped index view. A block holds
# the documents of one term whose ids fall in one id range of this width, so
# no block can grow past it whatever the term's frequency.
INDEX_BLOCK_IDS = 1024


def doc_count(articles: DataFrame, term: str, *, text: str = "text") -> DataFrame:
    """`term, n`: number of articles whose text mentions the term."""
    return (articles.where(mentions(text, term))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(term).alias("term"), "n"))


def term_hits(articles: DataFrame, vocab: Vocabulary, *, text: str = "text",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (article, mentioned term): `term, *keep`."""
    keep_cols = [F.col(c) for c in keep]
    if len(vocab) <= LITERAL_VOCAB_MAX:
        return articles.select(F.explode(vocabulary_hits(text, vocab)).alias("term"), *keep_cols)
    # Large vocabulary: distinct tokens of each article, equi-joined with the
    # vocabulary table. Its row count is the vocabulary length, known here:
    # broadcast up to `BROADCAST_VOCAB_MAX` terms, a shuffle join beyond.
    toks = articles.select(F.explode(F.array_distinct(tokens(text))).alias("term"), *keep_cols)
    table = vocab.frame(articles.sparkSession).select("term")
    if len(vocab) <= params.BROADCAST_VOCAB_MAX:
        table = F.broadcast(table)
    return toks.join(table, "term")


def rank_one_pass(articles: DataFrame, vocab: Vocabulary, *, text: str = "text") -> DataFrame:
    """`term, n` for terms with at least one article, by n descending (ties by
    term). Counting is partial per task, then final per term."""
    return (term_hits(articles, vocab, text=text)
            .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("term")))


def term_counts(articles: DataFrame, vocab: Vocabulary, *, text: str = "text") -> DataFrame:
    """`term, pos, n` for every vocabulary term, 0 when unmentioned.

    Small vocabulary: one global aggregate with a conditional count per term
    over the in-row hits, so each task sends a single row to the final
    aggregate and the zeros need no join; `stack` turns the row into one row
    per term. Large vocabulary: counts per term joined to the vocabulary."""
    if len(vocab) <= LITERAL_VOCAB_MAX:
        hits = articles.select(vocabulary_hits(text, vocab).alias("_h"))
        row = hits.agg(*[F.count_if(F.array_contains("_h", F.lit(t))).alias(f"_n{i}")
                         for i, t in enumerate(vocab.terms)])
        triples = [c for i, t in enumerate(vocab.terms) for c in (F.lit(t), F.lit(i), F.col(f"_n{i}"))]
        return row.select(F.stack(F.lit(len(vocab)), *triples).alias("term", "pos", "n"))
    counts = term_hits(articles, vocab, text=text).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return (vocab.frame(articles.sparkSession).join(counts, "term", "left")
            .select("term", "pos", F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def rank_zero_filled(articles: DataFrame, vocab: Vocabulary, *, text: str = "text") -> DataFrame:
    """`term, n` for every vocabulary term (0 when unmentioned), by n
    descending, ties in vocabulary order."""
    return (term_counts(articles, vocab, text=text)
            .orderBy(F.desc("n"), F.asc("pos"))
            .select("term", "n"))


def inverted_index(articles: DataFrame, vocab: Vocabulary, *, text: str = "text",
                   key: str = "doc_id", title: str = "title") -> DataFrame:
    """The inverted index as rows: `term, doc_id, title`, one per (term,
    article mentioning it). Terms without articles are absent. Kept flat so
    that a term found in most articles is still spread over many tasks."""
    return term_hits(articles, vocab, text=text, keep=(key, title))


def index_blocks(index: DataFrame, *, key: str = "doc_id", title: str = "title",
                 block_ids: int = INDEX_BLOCK_IDS) -> DataFrame:
    """Grouped view of the index: `term, block, n, articles` where `articles`
    is an id-sorted array of `struct(doc_id, title)` for ids in
    [block * block_ids, (block + 1) * block_ids) and `n` its size. Every array
    is bounded by `block_ids` distinct ids, however common the term. A reader
    of `n` alone builds no arrays (column pruning drops them)."""
    if block_ids <= 0:
        raise ValueError("block_ids must be positive")
    # exact floor division, also for negative or very large ids
    k, b = F.col(key), F.lit(block_ids)
    block = trunc_div(k - F.pmod(k, b), b)
    return (index.groupBy("term", block.alias("block"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.array_sort(F.collect_list(F.struct(F.col(key).alias(key), F.col(title).alias(title))))
                 .alias("articles")))


def rank_from_index(blocks: DataFrame) -> DataFrame:
    """`term, n` from the grouped index: the summed block sizes per term."""
    return (blocks.groupBy("term").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), F.asc("term")))
