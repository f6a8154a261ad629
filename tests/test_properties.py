"""Property tests on random small inputs against plain-Python definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import clustering as C
from quarry.operators import terms
from quarry.params import Vocabulary
from quarry.sources.postings import parse_postings, posting_line

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

WORDS = st.sampled_from(["a", "b", "A", "b,", "c", "", "a\nb", "\tc"])


@SETTINGS
@given(texts=st.lists(st.lists(WORDS, max_size=6).map(" ".join), min_size=1, max_size=8))
def test_document_counts_match_python_split(spark, texts):
    vocab = Vocabulary(("a", "b", "A", "c", "b,"))
    df = spark.createDataFrame([(i, str(i), t) for i, t in enumerate(texts)],
                               "doc_id bigint, title string, text string")
    expect = {t: sum(1 for x in texts if t in x.split(" ")) for t in vocab.terms}
    got = {r["term"]: r["n"] for r in terms.rank_zero_filled(df, vocab).collect()}
    assert got == expect
    one = {r["term"]: r["n"] for r in terms.rank_one_pass(df, vocab).collect()}
    assert one == {t: n for t, n in expect.items() if n}


INTS = st.integers(min_value=-(2 ** 40), max_value=2 ** 40)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([1, 2, 3]), INTS, st.none() | INTS, st.none() | INTS, INTS,
                               st.none() | st.sampled_from(["Scala", "C#", "\"q\"", "a b"])),
                     min_size=1, max_size=10))
def test_posting_lines_round_trip(spark, rows):
    schema = "posting_type int, id bigint, accepted_answer bigint, parent_id bigint, score bigint, tags string"
    df = spark.createDataFrame(rows, schema)
    back = parse_postings(df.select(posting_line(df).alias("value")))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


POINTS = st.lists(st.tuples(st.integers(0, 3).map(lambda t: t * 1000), st.integers(-20, 20)),
                  min_size=1, max_size=40)


@SETTINGS
@given(pts=POINTS, centres=st.lists(st.tuples(st.integers(0, 3000), st.integers(-20, 20)), min_size=1, max_size=5))
def test_one_round_matches_brute_force(spark, pts, centres):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id bigint, x bigint, y bigint")
    groups = {}
    for p in pts:
        best = min(range(len(centres)), key=lambda i: ((p[0] - centres[i][0]) ** 2 + (p[1] - centres[i][1]) ** 2, i))
        groups.setdefault(best, []).append(p)

    def tdiv(a, b):
        q = abs(a) // b
        return q if a >= 0 else -q

    expect = [(tdiv(sum(p[0] for p in groups[i]), len(groups[i])), tdiv(sum(p[1] for p in groups[i]), len(groups[i])))
              if i in groups else c for i, c in enumerate(centres)]
    assert C.step(df, centres) == expect
    assert C.step(C.weighted_points(df), centres, "w") == expect


RESPONDENT = st.tuples(st.sampled_from([1.0, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0]), st.sampled_from([1.0, 2.0]),
                       st.sampled_from([15.0, 22.0, 23.0, 55.0, 56.0, 80.0]),
                       *[st.integers(0, 600).map(float) for _ in range(5)])


@SETTINGS
@given(rows=st.lists(RESPONDENT, min_size=1, max_size=25))
def test_time_use_summary_matches_python(spark, rows):
    from quarry.operators import timeuse as TU
    names = ["telfs", "tesex", "teage", "t0101", "t1801x", "t0501", "t1805", "t1201"]
    df = spark.createDataFrame([(f"r{i}",) + r for i, r in enumerate(rows)],
                               ", ".join(["id string"] + [f"{n} double" for n in names]))
    p, w, o = TU.classify_columns(["id"] + names)
    assert (p, w, o) == (["t0101", "t1801x"], ["t0501", "t1805"], ["t1201"])
    groups = {}
    for telfs, tesex, teage, a, b, c, d, e in rows:
        if telfs > 4:
            continue
        key = ("working" if 1 <= telfs < 3 else "not working", "male" if tesex == 1 else "female",
               "young" if teage <= 22 else "active" if teage <= 55 else "elder")
        groups.setdefault(key, []).append((a / 60 + b / 60, c / 60 + d / 60, e / 60))
    got = {tuple(r[:3]): tuple(r[3:]) for r in TU.summary_grouped(TU.respondent_summary(df, p, w, o)).collect()}
    assert set(got) == set(groups)
    for key, vals in groups.items():
        for i in range(3):
            assert abs(got[key][i] - sum(v[i] for v in vals) / len(vals)) <= 0.05 + 1e-9
