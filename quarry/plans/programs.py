"""The three programs end to end over text files, as a user runs them:

* `rank_articles`: article lines -> the three rankings and the index.
* `cluster_postings`: posting lines -> best scores -> vectors -> k-means ->
  cluster report.
* `time_usage_by_life_period`: wide CSV -> classes -> summary -> grouped means.

Each returns DataFrames (or, for clustering, the k report rows the program
prints); nothing else crosses to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import clustering, postings, terms, timeuse
from quarry.params import LANGUAGE_VOCABULARY, KMeansParams, Vocabulary
from quarry.sources.articles import parse_articles
from quarry.sources.postings import parse_postings
from quarry.sources.text import read_lines
from quarry.sources.wide import read_wide_csv


@dataclass
class Rankings:
    zero_filled: DataFrame     # every term, zeros kept, ties in vocabulary order
    from_index: DataFrame      # from the grouped inverted index
    one_pass: DataFrame        # partial + final count per term
    index: DataFrame           # flat inverted index: term, doc_id, title


def rank_articles(spark: SparkSession, path: str | list[str],
                  vocab: Vocabulary = LANGUAGE_VOCABULARY) -> Rankings:
    """Article lines -> rankings. Lines carry no id, so each article gets one
    from its place in the scan (`monotonically_increasing_id` right after the
    file scan: the same on a re-run of a lost task, and dense within a split,
    so index blocks fill up)."""
    arts = parse_articles(read_lines(spark, path).select(
        F.monotonically_increasing_id().alias("doc_id"), "value"))
    index = terms.inverted_index(arts, vocab)
    return Rankings(
        zero_filled=terms.rank_zero_filled(arts, vocab),
        from_index=terms.rank_from_index(terms.index_blocks(index)),
        one_pass=terms.rank_one_pass(arts, vocab),
        index=index,
    )


def cluster_postings(spark: SparkSession, path: str | list[str],
                     params: KMeansParams = KMeansParams(),
                     tags: Vocabulary = LANGUAGE_VOCABULARY) -> clustering.ClusterRun:
    """Posting lines -> k-means over (tag, best answer score) -> cluster rows
    and report lines."""
    raw = parse_postings(read_lines(spark, path))
    vectors = postings.tag_vectors(postings.question_max_score(raw), tags, params.spread)
    return clustering.run_clustering(vectors, params, tags)


def time_usage_by_life_period(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Wide survey CSV -> mean hours per (working, sex, age), sorted."""
    names, df = read_wide_csv(spark, path)
    primary, work, other = timeuse.classify_columns(names)
    return timeuse.summary_grouped(timeuse.respondent_summary(df, primary, work, other))
