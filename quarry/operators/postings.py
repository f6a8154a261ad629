"""Questions and answers: validity, the question/answer join, the best answer
score per question and the (tag coordinate, score) vectors.

Scale notes. Question ids and answer parents are both large key spaces, so
joins are shuffle joins on the question id (Spark broadcasts a side only when
its estimated size is under the broadcast threshold). A question with a huge
share of all answers is handled two ways: the best-score path and the group
summaries first reduce the answers to one row per question with a partial +
final aggregate (map-side combine, so a hot question costs one row per task),
and only then join, 1:1; the flat pair join and the grouped view rely on
adaptive execution to split a skewed shuffle partition across tasks
(`spark.sql.adaptive.skewJoin.enabled`, see tests/test_skew.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.params import Vocabulary
from quarry.session import reread

QUESTION, ANSWER = 1, 2
# Rows per part of the grouped pair view, and the most hot questions (over
# that many answers) sent to every task as a broadcast (see `grouped_pairs`).
PAIRS_PER_PART = 4096
HOT_BROADCAST_MAX = 100_000


def valid_postings(postings: DataFrame) -> DataFrame:
    """Questions, and answers that name a parent; adds the routing key `qid`
    (own id for a question, parent id for an answer). Other types vanish."""
    t = F.col("posting_type")
    valid = (t == QUESTION) | ((t == ANSWER) & F.col("parent_id").isNotNull())
    return (postings.where(valid)
            .select(F.when(t == QUESTION, F.col("id")).otherwise(F.col("parent_id")).alias("qid"),
                    *postings.columns))


def questions(valid: DataFrame) -> DataFrame:
    return valid.where(F.col("posting_type") == QUESTION)


def answers(valid: DataFrame) -> DataFrame:
    return valid.where(F.col("posting_type") == ANSWER)


def qa_pairs(postings: DataFrame) -> DataFrame:
    """Inner join of questions and answers on the question id, flat:
    `qid, tags, answer_id, answer_score`. Questions without answers and answers
    without a question vanish; a duplicated question id multiplies pairs."""
    v = valid_postings(postings)
    q = questions(v).select("qid", "tags")
    a = answers(v).select("qid", F.col("id").alias("answer_id"), F.col("score").alias("answer_score"))
    return q.join(a, "qid", "inner")


def _hot_questions(answers_by_qid: DataFrame, rows_per_bucket: int, broadcast_max: int) -> DataFrame:
    """`qid, _n`: questions with more than `rows_per_bucket` answers, counted
    with a partial + final aggregate. Broadcast when there are at most
    `broadcast_max` of them (checked with a count), joined by shuffle beyond.
    With a checkpoint folder the hot list is written once, so the count and
    the join do not aggregate all answers twice."""
    counts = answers_by_qid.groupBy("qid").agg(F.count(F.lit(1)).alias("_n"))
    hot = reread(counts.where(F.col("_n") > F.lit(rows_per_bucket)))
    return F.broadcast(hot) if hot.count() <= broadcast_max else hot


def _salted_pairs(postings: DataFrame, rows_per_bucket: int, hot_broadcast_max: int) -> DataFrame:
    """Pairs with a salt bucket: `qid, tags, answer_id, answer_score, _salt,
    _n` (`_n` = answer count of a hot question, null otherwise)."""
    if rows_per_bucket <= 0:
        raise ValueError("rows_per_bucket must be positive")
    v = valid_postings(postings)
    a = answers(v).select("qid", F.col("id").alias("answer_id"), F.col("score").alias("answer_score"))
    hot = _hot_questions(a, rows_per_bucket, hot_broadcast_max)
    buckets = F.coalesce(F.ceil(F.col("_n") / F.lit(rows_per_bucket)), F.lit(1))
    salted_answers = (a.join(hot, "qid", "left")
                      .select("qid", "answer_id", "answer_score", "_n",
                              F.pmod(F.xxhash64("answer_id", "answer_score"), buckets).alias("_salt")))
    salted_questions = (questions(v).select("qid", "tags").join(hot.select("qid", F.col("_n").alias("_qn")),
                                                                 "qid", "left")
                        .select("qid", "tags", F.explode(F.sequence(
                            F.lit(0).cast("bigint"),
                            F.coalesce(F.ceil(F.col("_qn") / F.lit(rows_per_bucket)), F.lit(1)) - 1))
                            .alias("_salt")))
    return salted_questions.join(salted_answers, ["qid", "_salt"], "inner")


def qa_pairs_salted(postings: DataFrame, *, rows_per_bucket: int = PAIRS_PER_PART,
                    hot_broadcast_max: int = HOT_BROADCAST_MAX) -> DataFrame:
    """`qa_pairs` with hot questions salted, for sessions where adaptive
    execution is off or cannot split the join. A question with n answers over
    `rows_per_bucket` spreads its answers over ceil(n / rows_per_bucket) salt
    buckets by a hash of the answer, and only that question's row is repeated
    once per bucket; every other question has one bucket. The join on
    (qid, salt) then sends each bucket to its own task. Same rows as
    `qa_pairs`."""
    return (_salted_pairs(postings, rows_per_bucket, hot_broadcast_max)
            .select("qid", "tags", "answer_id", "answer_score"))


def grouped_pairs(postings: DataFrame, *, part_rows: int = PAIRS_PER_PART,
                  hot_broadcast_max: int = HOT_BROADCAST_MAX) -> DataFrame:
    """The pairs grouped per question as arrays: `qid, part, n_answers, pairs`.

    A question with more than `part_rows` answers is split into
    ceil(n / part_rows) parts by a hash of the answer, so no array has to
    hold an unbounded group; a question's parts together hold all its pairs.
    The parts are the salt buckets of `qa_pairs_salted`: its join on
    (qid, part) already places every part in one partition, so the grouping
    adds no shuffle, and a hot question's parts are in different tasks."""
    pairs = _salted_pairs(postings, part_rows, hot_broadcast_max)
    grouped = (pairs.groupBy("qid", "_salt")
               .agg(F.max("_n").alias("_n"),
                    F.array_sort(F.collect_list(F.struct("answer_id", "answer_score", "tags"))).alias("pairs")))
    # a cold question is one part, so its size is its array's size
    return grouped.select("qid", F.col("_salt").alias("part"),
                          F.coalesce(F.col("_n"), F.size("pairs").cast("bigint")).alias("n_answers"), "pairs")


def qa_groups(postings: DataFrame) -> DataFrame:
    """Per answered question: `qid, n_answers, min_answer_id, max_answer_id`,
    the summary of its group of pairs. The answers are aggregated per
    question first (partial per task, so group size does not matter), then
    kept when their question exists: an inner join on unique keys (question
    ids are unique, so each answer is one pair). A left semi join would say
    the same, but Catalyst pushes a semi join on the grouping key below the
    aggregate, which would shuffle every answer before reducing."""
    v = valid_postings(postings)
    per_question = answers(v).groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.min("id").alias("min_answer_id"),
        F.max("id").alias("max_answer_id"),
    )
    return per_question.join(questions(v).select("qid"), "qid", "inner")


def question_max_score(postings: DataFrame) -> DataFrame:
    """`qid, tags, max_score`: best answer score of every answered question
    (negative scores included), one row per question id. One aggregation over
    both kinds of posting: one scan, one shuffle, no join. Should a question
    id occur twice, the greater tag is taken (see `duplicate_questions`)."""
    question, answer = F.col("posting_type") == QUESTION, F.col("posting_type") == ANSWER
    return (valid_postings(postings).groupBy("qid")
            .agg(F.max(F.when(question, F.struct("tags"))).alias("_q"),
                 F.max(F.when(answer, F.col("score"))).alias("max_score"))
            .where(F.col("_q").isNotNull() & F.col("max_score").isNotNull())
            .select("qid", F.col("_q.tags").alias("tags"), "max_score"))


def duplicate_questions(postings: DataFrame) -> DataFrame:
    """Question ids that occur more than once (a contract violation: the join
    would multiply their pairs). Empty on valid input."""
    q = questions(valid_postings(postings))
    return q.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def tag_vectors(scored: DataFrame, tags: Vocabulary, spread: int) -> DataFrame:
    """`id, x, y`: x = position of the question's tag (whole string, first
    equal position) times `spread`, y = best answer score. Questions whose tag
    is null or unknown are dropped. The tag list is a literal array (its
    length is a parameter), so this is a projection, not a join."""
    pos = tags.position(F.col("tags"))
    return (scored.select(F.col("qid").alias("id"), pos.alias("_pos"), F.col("max_score").alias("y"))
            .where(F.col("_pos").isNotNull())
            .select("id", (F.col("_pos").cast("bigint") * F.lit(spread)).alias("x"), "y"))
