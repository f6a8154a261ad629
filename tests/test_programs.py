"""The three programs over text files written to a scratch folder."""

import os

from conftest import SF_SMALL
from quarry.params import KMeansParams, Vocabulary
from quarry.plans import programs
from quarry.sources import bindings as B
from quarry.sources.articles import MARKER


def write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_rank_articles_from_file(spark, scratch):
    texts = ["Our Groovy build starts an Erlang node", "One Java service calls a Scala job",
             "That Scala code needs tests", "Rewriting Java modules in Haskell took weeks",
             "A Java upgrade is due"]
    lines = [f"<page> <title>{i}{MARKER}{t}</text> </page> " for i, t in enumerate(texts)]
    r = programs.rank_articles(spark, write(scratch, "wiki.dat", lines),
                               Vocabulary(("Scala", "Java", "Groovy", "Haskell", "Erlang")))
    one = [(x["term"], x["n"]) for x in r.one_pass.collect()]
    assert one[0] == ("Java", 3)
    assert set(one) == {(x["term"], x["n"]) for x in r.from_index.collect()}
    assert set(one) == {(x["term"], x["n"]) for x in r.zero_filled.collect()}
    assert r.index.count() == 8


def test_cluster_postings_from_file(spark, scratch):
    rows = B.posting_lines(spark, SF_SMALL).collect()
    path = write(scratch, "postings.csv", [r["value"] for r in rows])
    params = KMeansParams(spread=50000, k=8, eta=20.0, max_iter=40)
    run = programs.cluster_postings(spark, path, params, B.POSTING_TAGS)
    assert len(run.stats) <= 8 and run.report[0] == "Resulting clusters:"
    total = sum(s["size"] for s in run.stats)
    from quarry.operators import postings
    expect = postings.tag_vectors(postings.question_max_score(B.postings(spark, SF_SMALL)),
                                  B.POSTING_TAGS, 50000).count()
    assert total == expect


def test_time_usage_from_csv(spark, scratch):
    r = B.respondents(spark, SF_SMALL)
    rows = r.collect()
    lines = [",".join(B.RESPONDENT_COLUMNS)] + [
        ",".join([x[0]] + [repr(v) for v in x[1:]]) for x in rows]
    folder = os.path.join(scratch, "tu")
    os.makedirs(folder)
    half = len(lines) // 2
    write(folder, "a.csv", lines[:half])
    write(folder, "b.csv", [lines[0]] + lines[half:])      # each file has a header
    got = [tuple(x) for x in programs.time_usage_by_life_period(spark, folder).collect()]
    from quarry.operators import timeuse
    p, w, o = timeuse.classify_columns(r.columns)
    expect = [tuple(x) for x in timeuse.summary_grouped(timeuse.respondent_summary(r, p, w, o)).collect()]
    assert got == expect
