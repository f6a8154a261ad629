"""The named queries. Each takes (spark, sf_dir) and returns a DataFrame over
the whole of the driver's tables; column names equal the oracle's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import clustering, postings, sampling, term_tables, terms, timeuse
from quarry.session import reread, stored
from quarry.sources import bindings as B
from quarry.sources.articles import parse_articles
from quarry.sources.postings import parse_postings
from quarry.sources.text import read_lines
from quarry.sources.wide import parse_wide_lines, read_wide_csv

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = fn
        return fn
    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- term ranking ------------------------------------------------------------

@query("page_line_parse")
def page_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_articles(B.article_lines(spark, sf_dir)).select("doc_id", "title", "text")


@query("page_file_parse")
def page_file_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_articles(read_lines(spark, B.article_files(spark, sf_dir))).select("title", "text")


@query("term_doc_count")
def term_doc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.doc_count(B.articles(spark, sf_dir), B.DOC_TERMS.terms[0])


@query("term_rank_zero_filled")
def term_rank_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.rank_zero_filled(B.articles(spark, sf_dir), B.DOC_TERMS)


@query("term_index")
def term_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.inverted_index(B.articles(spark, sf_dir), B.DOC_TERMS)


@query("term_index_blocks")
def term_index_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grouped index, a block's ids as one string."""
    blocks = terms.index_blocks(terms.inverted_index(B.articles(spark, sf_dir), B.DOC_TERMS))
    ids = F.concat_ws(",", F.transform("articles", lambda a: a["doc_id"].cast("string")))
    return blocks.select("term", "block", "n", ids.alias("doc_ids"))


@query("term_rank_from_index")
def term_rank_from_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = terms.inverted_index(B.articles(spark, sf_dir), B.DOC_TERMS)
    return terms.rank_from_index(terms.index_blocks(index))


@query("term_rank_one_pass")
def term_rank_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.rank_one_pass(B.articles(spark, sf_dir), B.DOC_TERMS)


@query("term_table_rank")
def term_table_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_tables.rank(B.articles(spark, sf_dir), stored(B.term_table(spark, sf_dir)))


@query("term_table_rank_zero_filled")
def term_table_rank_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_tables.rank_zero_filled(B.articles(spark, sf_dir), stored(B.term_table(spark, sf_dir)))


@query("term_table_index")
def term_table_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_tables.inverted_index(B.articles(spark, sf_dir), stored(B.term_table(spark, sf_dir)))


@query("term_index_ranked")
def term_index_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting lists by rank, of ids spread over all of bigint; deltas as one string."""
    articles = B.articles(spark, sf_dir).withColumn("doc_id", F.conv(F.substring(F.md5("title"), 1, 15), 16, 10).cast("bigint"))
    index = terms.inverted_index(articles, B.DOC_TERMS)
    blocks = term_tables.ranked_blocks(index, block_docs=B.RANKED_BLOCK_DOCS)
    text = F.concat_ws(",", F.transform("deltas", lambda d: d.cast("string")))
    return blocks.select("term", "block", "n", "first_id", text.alias("deltas"), F.concat_ws(",", "titles").alias("titles"))


# -- postings, scores, vectors -----------------------------------------------

def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = postings.question_max_score(B.postings(spark, sf_dir))
    return postings.tag_vectors(scored, B.POSTING_TAGS, B.POSTING_KMEANS.spread)


def _seeds(vectors: DataFrame) -> list[tuple[int, int]]:
    return sampling.seed_centres(vectors, B.POSTING_KMEANS_FIXED, len(B.POSTING_TAGS))


@query("posting_line_parse")
def posting_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_postings(B.posting_lines(spark, sf_dir))


@query("posting_file_read")
def posting_file_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_postings(read_lines(spark, B.posting_files(spark, sf_dir)))


@query("posting_valid")
def posting_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.valid_postings(B.postings(spark, sf_dir))


@query("qa_pairs")
def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # hot questions are salted, whatever the session's skew settings
    return postings.qa_pairs_salted(B.postings(spark, sf_dir))


@query("qa_grouped_pairs")
def qa_grouped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs grouped per question, as one string of answer:score."""
    pair = lambda p: F.concat_ws(":", p["answer_id"].cast("string"), p["answer_score"].cast("string"))
    return postings.grouped_pairs(B.postings(spark, sf_dir)).select(
        "qid", "part", "n_answers", F.concat_ws(",", F.transform("pairs", pair)).alias("answers"))


@query("qa_groups")
def qa_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.qa_groups(B.postings(spark, sf_dir))


@query("question_max_score")
def question_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.question_max_score(B.postings(spark, sf_dir))


@query("duplicate_questions")
def duplicate_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.duplicate_questions(B.postings(spark, sf_dir))


@query("tag_score_vectors")
def tag_score_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir)


@query("seed_sample_per_tag")
def seed_sample_per_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_per_tag(_vectors(spark, sf_dir), B.POSTING_KMEANS_FIXED, len(B.POSTING_TAGS))


@query("seed_sample_global")
def seed_sample_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = B.POSTING_KMEANS_FIXED
    return sampling.sample_global(_vectors(spark, sf_dir), p.k, p.seed)


@query("nearest_centre")
def nearest_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    # seeds and the per-point rows read the same checkpointed vectors
    # when the session names a checkpoint folder
    v = reread(_vectors(spark, sf_dir))
    return clustering.assign(v, _seeds(v)).select("id", "x", "y", "k")


@query("nearest_of_many")
def nearest_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1,500 centres, searched by bisection on every brand's line."""
    scored = postings.question_max_score(B.brand_postings(spark, sf_dir))
    vectors = postings.tag_vectors(scored, B.BRAND_TAGS, B.BRAND_KMEANS.spread)
    lines = [i * B.BRAND_KMEANS.spread for i in range(len(B.BRAND_TAGS))]
    return clustering.assign(vectors, B.MANY_CENTRES, lines).select("id", "x", "y", "k")


def _seeded_points(spark: SparkSession, sf_dir: str):
    """Weighted points and seeds from one pass over the vectors (see
    `clustering.seeded_points`)."""
    return clustering.seeded_points(_vectors(spark, sf_dir), B.POSTING_KMEANS_FIXED, len(B.POSTING_TAGS))


@query("centre_means")
def centre_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, seeds = _seeded_points(spark, sf_dir)
    return clustering.centre_means(clustering.assign(points, seeds), "w")


@query("kmeans_step")
def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, seeds = _seeded_points(spark, sf_dir)
    return clustering.step_frame(points, seeds, "w")


@query("centre_movement")
def centre_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, seeds = _seeded_points(spark, sf_dir)
    return clustering.movement_frame(clustering.centres_frame(spark, seeds),
                                     clustering.step_frame(points, seeds, "w"))


@query("kmeans_fit")
def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.fit(_vectors(spark, sf_dir), B.POSTING_KMEANS_FIXED, len(B.POSTING_TAGS)).centres_df(spark)


def _fit_until_still(spark: SparkSession, sf_dir: str) -> clustering.KMeansResult:
    return clustering.fit(_vectors(spark, sf_dir), B.POSTING_KMEANS, len(B.POSTING_TAGS))


@query("kmeans_fit_converged")
def kmeans_fit_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_until_still(spark, sf_dir).centres_df(spark)


@query("kmeans_history")
def kmeans_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_until_still(spark, sf_dir).history_df(spark)


@query("kmeans_fit_brands")
def kmeans_fit_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen tags, 45 centres, rounds until the movement is below eta."""
    scored = postings.question_max_score(B.brand_postings(spark, sf_dir))
    vectors = postings.tag_vectors(scored, B.BRAND_TAGS, B.BRAND_KMEANS.spread)
    return clustering.fit(vectors, B.BRAND_KMEANS, len(B.BRAND_TAGS)).centres_df(spark)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics over the weighted points of the fit (no second pass over
    the postings join when the session names a checkpoint folder)."""
    return clustering.fitted_stats(_vectors(spark, sf_dir), B.POSTING_KMEANS_FIXED, B.POSTING_TAGS)


@query("cluster_dominant_tag")
def cluster_dominant_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("k", "tag")


@query("cluster_percent")
def cluster_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("k", "pct")


@query("cluster_median")
def cluster_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("k", "median_score")


@query("cluster_summary")
def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir)


@query("cluster_report")
def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_report(_stats(spark, sf_dir))


# -- time use ------------------------------------------------------------------

def _respondents(spark: SparkSession, sf_dir: str):
    r = B.respondents(spark, sf_dir)
    return r, timeuse.classify_columns(r.columns)


@query("wide_read")
def wide_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, df = parse_wide_lines(B.respondent_lines(spark, sf_dir))
    return df


@query("wide_file_read")
def wide_file_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_wide_csv(spark, B.respondent_files(spark, sf_dir))[1]


def _lenient(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    _, rows, rejects = read_wide_csv(spark, B.damaged_respondent_files(spark, sf_dir), mode="lenient")
    return rows, rejects


@query("wide_lenient_rows")
def wide_lenient_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lenient(spark, sf_dir)[0]


@query("wide_lenient_rejects")
def wide_lenient_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lenient(spark, sf_dir)[1]


@query("wide_lenient_counts")
def wide_lenient_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and rejects by reason and column."""
    rows, rejects = _lenient(spark, sf_dir)
    accepted = rows.select(F.lit("accepted").alias("reason"), F.lit(None).cast("string").alias("column"))
    return (accepted.unionByName(rejects.select("reason", "column"))
            .groupBy("reason", "column").agg(F.count(F.lit(1)).alias("n")))


@query("wide_permissive_counts")
def wide_permissive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line a row: how many are kept whole, and how many numbers are read."""
    _, df = read_wide_csv(spark, B.damaged_respondent_files(spark, sf_dir), mode="permissive")
    return df.agg(F.count(F.lit(1)).alias("n_lines"), F.count("_corrupt_record").alias("n_corrupt"),
                  *[F.count(c).alias(f"n_{c}") for c in B.RESPONDENT_COLUMNS[1:]])


@query("respondent_recode")
def respondent_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, _ = _respondents(spark, sf_dir)
    return timeuse.recoded(r, keep=("tucaseid",))


@query("activity_hours")
def activity_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, (p, w, o) = _respondents(spark, sf_dir)
    return timeuse.activity_hours(r, p, w, o, keep=("tucaseid",))


@query("respondent_summary")
def respondent_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, (p, w, o) = _respondents(spark, sf_dir)
    return timeuse.respondent_summary(r, p, w, o)


@query("summary_grouped")
def summary_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.summary_grouped(respondent_summary(spark, sf_dir))


@query("summary_grouped_sql")
def summary_grouped_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.summary_grouped_sql(respondent_summary(spark, sf_dir))


@query("summary_grouped_typed")
def summary_grouped_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuse.summary_grouped_typed(timeuse.summary_typed(respondent_summary(spark, sf_dir)))
