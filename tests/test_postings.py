from collections import defaultdict

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import postings as P
from quarry.params import Vocabulary
from quarry.sources import bindings as B

SCHEMA = "posting_type int, id bigint, accepted_answer bigint, parent_id bigint, score bigint, tags string"


def posts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    (1, 10, None, None, 0, "Scala"),
    (1, 20, None, None, 0, "Java"),
    (1, 30, None, None, 0, None),      # no tag
    (1, 40, None, None, 0, "Cobol"),   # unknown tag
    (1, 50, None, None, 0, "Java"),    # no answer
    (2, 11, None, 10, 5, None),
    (2, 12, None, 10, 9, None),
    (2, 21, None, 20, -3, None),       # only negative answers
    (2, 22, None, 20, -1, None),
    (2, 31, None, 30, 4, None),
    (2, 41, None, 40, 7, None),
    (2, 99, None, None, 8, None),      # answer without parent: invalid
    (2, 98, None, 77, 8, None),        # parent does not exist
    (3, 97, None, 10, 100, None),      # other posting type: invalid
]


def test_valid_and_routing_key(spark):
    v = P.valid_postings(posts(spark, ROWS))
    got = {(r["id"], r["qid"]) for r in v.collect()}
    assert (99, None) not in got and all(i != 97 for i, _ in got)
    assert (11, 10) in got and (10, 10) in got and (98, 77) in got


def test_pairs_inner_join(spark):
    pairs = P.qa_pairs(posts(spark, ROWS))
    got = sorted((r["qid"], r["answer_id"]) for r in pairs.collect())
    assert got == [(10, 11), (10, 12), (20, 21), (20, 22), (30, 31), (40, 41)]


def test_max_score_negative_groups(spark):
    got = {r["qid"]: (r["tags"], r["max_score"]) for r in P.question_max_score(posts(spark, ROWS)).collect()}
    assert got == {10: ("Scala", 9), 20: ("Java", -1), 30: (None, 4), 40: ("Cobol", 7)}


def test_vectors_first_position_whole_tag(spark):
    scored = P.question_max_score(posts(spark, ROWS))
    tags = Vocabulary(("JavaScript", "Java", "Scala"))
    got = sorted(tuple(r) for r in P.tag_vectors(scored, tags, 100).collect())
    assert got == [(10, 200, 9), (20, 100, -1)]   # "Java" is not "JavaScript"; unknown/null dropped


def test_groups_summary(spark):
    got = {r["qid"]: (r["n_answers"], r["min_answer_id"], r["max_answer_id"])
           for r in P.qa_groups(posts(spark, ROWS)).collect()}
    assert got[10] == (2, 11, 12) and got[20] == (2, 21, 22) and len(got) == 4


def test_grouped_pairs_split_a_hot_question(spark):
    hot = [(1, 1, None, None, 0, "Java")] + [(2, 100 + i, None, 1, i % 7, None) for i in range(3000)]
    cold = [(1, 2, None, None, 0, "Scala"), (2, 5000, None, 2, 3, None)]
    g = P.grouped_pairs(posts(spark, hot + cold), part_rows=500).collect()
    hot_parts = [r for r in g if r["qid"] == 1]
    assert len(hot_parts) == 6                       # ceil(3000 / 500) parts
    assert max(len(r["pairs"]) for r in hot_parts) < 800
    ids = sorted(p["answer_id"] for r in hot_parts for p in r["pairs"])
    assert ids == list(range(100, 3100))
    assert [len(r["pairs"]) for r in g if r["qid"] == 2] == [1]
    assert {r["n_answers"] for r in g if r["qid"] == 1} == {3000}
    assert [r["n_answers"] for r in g if r["qid"] == 2] == [1]
    # the same result when the hot questions are joined without a broadcast
    g2 = P.grouped_pairs(posts(spark, hot + cold), part_rows=500, hot_broadcast_max=0).collect()
    assert sorted((r["qid"], r["part"], r["n_answers"], len(r["pairs"])) for r in g2) == \
        sorted((r["qid"], r["part"], r["n_answers"], len(r["pairs"])) for r in g)


def test_duplicate_question_ids_reported(spark):
    rows = ROWS + [(1, 10, None, None, 0, "Java")]
    got = [(r["qid"], r["n"]) for r in P.duplicate_questions(posts(spark, rows)).collect()]
    assert got == [(10, 2)]
    assert P.duplicate_questions(B.postings(spark, SF_SMALL)).count() == 0


def test_brute_force_on_binding(spark):
    rows = [tuple(r) for r in B.postings(spark, SF_SMALL).collect()]
    questions = {r[1]: r[5] for r in rows if r[0] == 1}
    best = defaultdict(lambda: None)
    for t, i, _, parent, score, _ in rows:
        if t == 2 and parent is not None and parent in questions:
            best[parent] = score if best[parent] is None else max(best[parent], score)
    expect = {q: (questions[q], s) for q, s in best.items()}
    got = {r["qid"]: (r["tags"], r["max_score"])
           for r in P.question_max_score(B.postings(spark, SF_SMALL)).collect()}
    assert got == expect


def test_max_score_is_one_aggregation_without_a_join(spark):
    plan = P.question_max_score(B.postings(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_max_score_gives_one_row_per_question_id(spark):
    rows = [(1, 10, None, None, 0, "a"), (1, 10, None, None, 0, "b"), (2, 11, None, 10, 7, None)]
    df = spark.createDataFrame(rows, "posting_type int, id bigint, accepted_answer bigint, parent_id bigint, "
                                     "score bigint, tags string")
    assert [tuple(r) for r in P.question_max_score(df).collect()] == [(10, "b", 7)]
    assert [tuple(r) for r in P.duplicate_questions(df).collect()] == [(10, 2)]


def test_vectors_have_no_join(spark):
    scored = P.question_max_score(B.postings(spark, SF_SMALL))
    v = P.tag_vectors(scored, B.POSTING_TAGS, 50000)
    assert v.where(F.col("x") % 50000 != 0).count() == 0
    assert {r["x"] // 50000 for r in v.select("x").distinct().collect()} == {0, 1, 2, 3}


def test_vectors_read_only_the_columns_they_use(spark):
    scored = P.question_max_score(B.postings(spark, SF_SMALL))
    plan = P.tag_vectors(scored, B.POSTING_TAGS, 50000)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
    for unused in ("o_totalprice", "o_orderdate", "l_extendedprice", "l_discount", "l_shipdate", "l_partkey"):
        assert unused not in plan
