"""Term ranking and the index for vocabularies that are tables of any size, and
posting lists cut by rank.

Plan. The vocabulary is a frame with a `term` column.

- Counts: tokens are counted in the task first (partial + final), and only
  (token, count) rows meet the vocabulary: a token of every document is one row
  a task. A Bloom filter of the tokens (up to `BLOOM_BITS` bits, so up to 8 MB; a
  scalar subquery) is tested on the vocabulary in its scan: terms that no
  document has, however many, are not shuffled. The exact test is a join.
- Rankings are these counts.
- Index: its rows are the hits themselves, so the join meets all of them, but only
  with the terms that the counts have found. Those with more than a `HOT_TERMS`-th
  of all hits, at most `HOT_TERMS` by arithmetic, are joined by broadcast and
  their hits stay where they are. Of the others the shuffle join holds at most
  that share of the hits a term; a Bloom filter of these terms is tested in the
  scan, which leaves their tokens and few others.
- Posting lists: hits are range-partitioned by (term, id) and written once; counts
  per term and range add up to every range's first position, so a position within
  the term needs no task that sees all of a term. Blocks are equal shares of
  a term's positions, whatever the ids are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import tokens
from quarry.session import stored

BLOOM_BITS = 1 << 26
BITS_PER_TERM = 12
BLOOM_HASHES = 4
HOT_TERMS = 200_000
BLOCK_DOCS = 1024


def vocabulary_table(terms: DataFrame, column: str = "term") -> DataFrame:
    """`term`: the distinct non-empty terms of a column."""
    return terms.select(F.col(column).alias("term")).where((F.col("term") != "") & F.col("term").isNotNull()).distinct()


# The filter ------------------------------------------------------------------------

def bloom_bits(n_terms: int) -> int:
    """Bits of the filter: a power of two, `BITS_PER_TERM` a term, at most `BLOOM_BITS`."""
    return min(BLOOM_BITS, 1 << max(10, (n_terms * BITS_PER_TERM - 1).bit_length()))


def _positions(term: Column, bits: int) -> list[Column]:
    h = F.xxhash64(term)
    low, high = h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(low + F.lit(i) * high).bitwiseAND(F.lit(bits - 1)) for i in range(BLOOM_HASHES)]


def bloom_filter(vocab: DataFrame, bits: int) -> DataFrame:
    """The filter's words of 64 bits as one row with one array."""
    spots = vocab.select(F.explode(F.array(*_positions(F.col("term"), bits))).alias("_p"))
    words = (spots.groupBy(F.shiftright("_p", 6).alias("id"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_p & 63L AS int))")).alias("_w")))
    every = vocab.sparkSession.range(bits // 64).join(words, "id", "left")      # bits / 64 rows
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("_w", F.lit(0)).alias("w")))),
                                 lambda s: s["w"]).alias("words"))


def _among(term: Column, terms: DataFrame) -> Column:
    """Whether the filter of `terms` lets a term pass: true of all of them, and few others."""
    bits = bloom_bits(terms.count())
    words = bloom_filter(terms, bits).scalar()
    passes = F.lit(True)
    for p in _positions(term, bits):
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        passes = passes & (F.call_function("getbit", word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return passes


def _tokens(articles: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """`term, *keep`: the distinct tokens of every article."""
    return articles.select(F.explode(F.array_distinct(tokens(text))).alias("term"), *[F.col(c) for c in keep])


def candidates(articles: DataFrame, vocab: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """`term, *keep`: the distinct tokens of every article that the filter of the
    vocabulary lets pass: all of its terms, and few others."""
    return _tokens(articles, text, keep).where(_among(F.col("term"), vocab))


# Rankings --------------------------------------------------------------------------

def term_counts(articles: DataFrame, vocab: DataFrame, *, text: str = "text") -> DataFrame:
    """`term, n` for the terms of the vocabulary with at least one article."""
    counts = stored(_tokens(articles, text).groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return counts.join(vocab.select("term").where(_among(F.col("term"), counts)), "term")


def rank(articles: DataFrame, vocab: DataFrame, *, text: str = "text") -> DataFrame:
    """`term, n` by n descending, ties by term."""
    return term_counts(articles, vocab, text=text).orderBy(F.desc("n"), F.asc("term"))


def rank_zero_filled(articles: DataFrame, vocab: DataFrame, *, text: str = "text") -> DataFrame:
    """`term, n` for every term of the vocabulary, by n descending, ties by term."""
    counts = term_counts(articles, vocab, text=text)
    return (vocab.select("term").join(counts, "term", "left")
            .select("term", F.coalesce("n", F.lit(0)).alias("n")).orderBy(F.desc("n"), F.asc("term")))


def inverted_index(articles: DataFrame, vocab: DataFrame, *, text: str = "text", key: str = "doc_id",
                   title: str = "title", hot_terms: int = HOT_TERMS) -> DataFrame:
    """`term, doc_id, title`: one row per (term, article that mentions it)."""
    counts = stored(term_counts(articles, vocab, text=text))
    total = counts.agg(F.sum("n")).first()[0] or 0
    # fewer than hot_terms + 1 terms can have more than a hot_terms-th of all
    is_hot = F.col("n") > F.lit(total // hot_terms + 1)
    hot = F.broadcast(counts.where(is_hot).select("term", F.lit(True).alias("_in")))
    seldom = counts.where(~is_hot).select("term")
    found = _tokens(articles, text, (key, title)).join(hot, "term").drop("_in")
    # hot terms that the filter lets pass are not shuffled either
    rest = (candidates(articles, seldom, text=text, keep=(key, title)).join(hot, "term", "left")
            .where(F.col("_in").isNull()).drop("_in").join(seldom, "term"))
    return found.unionByName(rest)


# Posting lists by rank ---------------------------------------------------------------

def ranked_blocks(index: DataFrame, *, key: str = "doc_id", title: str = "title", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """`term, block, n, first_id, deltas, titles`: a term's articles in order of
    their ids, cut into ceil(N / block_docs) blocks of equal shares (one more or
    less), N being the term's articles. `deltas` holds 0 and then every id less the
    one before; `block_ids` gives the ids back."""
    if block_docs <= 0:
        raise ValueError("block_docs must be positive")
    dealt = stored(index.select("term", F.col(key).alias("_id"), F.col(title).alias("_title"))
                   .repartitionByRange("term", "_id").withColumn("_range", F.spark_partition_id()))
    # one row per term and range
    counts = dealt.groupBy("term", "_range").agg(F.count(F.lit(1)).alias("_n"))
    ranges = Window.partitionBy("term")
    before = F.sum("_n").over(ranges.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("term", "_range", F.coalesce(before, F.lit(0)).alias("_first"), F.sum("_n").over(ranges).alias("_all"))
    within = F.row_number().over(Window.partitionBy("term", "_range").orderBy("_id")) - 1
    placed = (dealt.withColumn("_at", within).join(first, ["term", "_range"])
              .withColumn("_at", F.col("_at") + F.col("_first")))
    n_blocks = F.ceil(F.col("_all") / F.lit(block_docs))
    block = F.expr(f"(_at * ceil(_all / {int(block_docs)})) div _all")
    grouped = (placed.where(n_blocks > 0).groupBy("term", block.alias("block"))
               .agg(F.array_sort(F.collect_list(F.struct("_id", "_title"))).alias("_docs")))
    ids = F.transform("_docs", lambda d: d["_id"])
    delta = F.zip_with(ids, F.concat(F.array(F.get(ids, F.lit(0))), F.slice(ids, F.lit(1), F.size(ids) - 1)), lambda a, b: a - b)
    return grouped.select("term", "block", F.size("_docs").cast("bigint").alias("n"), F.get(ids, F.lit(0)).alias("first_id"),
                          delta.alias("deltas"), F.transform("_docs", lambda d: d["_title"]).alias("titles"))


def block_ids(first_id: Column, deltas: Column) -> Column:
    """The ids of a block: running sums of its deltas."""
    start = F.struct(first_id.alias("last"), F.array().cast("array<bigint>").alias("ids"))
    return F.aggregate(deltas, start, lambda acc, d: F.struct(
        (acc["last"] + d).alias("last"), F.concat(acc["ids"], F.array(acc["last"] + d)).alias("ids")), lambda acc: acc["ids"])
