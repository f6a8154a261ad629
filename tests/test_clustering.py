"""k-means and cluster statistics against a plain-Python brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import clustering as C
from quarry.operators import postings as P
from quarry.operators import sampling as S
from quarry.params import KMeansParams, Vocabulary
from quarry.sources import bindings as B


def points(spark, pts):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id bigint, x bigint, y bigint")


# -- plain Python reference behaviour --------------------------------------------

def py_nearest(p, centres):
    best, best_d = 0, None
    for i, c in enumerate(centres):
        d = (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2
        if best_d is None or d < best_d:
            best, best_d = i, d
    return best


def py_tdiv(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def py_kmeans(pts, centres, eta, max_iter):
    for _ in range(max_iter):
        groups = {}
        for p in pts:
            groups.setdefault(py_nearest(p, centres), []).append(p)
        new = []
        for i, c in enumerate(centres):
            g = groups.get(i)
            new.append((py_tdiv(sum(p[0] for p in g), len(g)), py_tdiv(sum(p[1] for p in g), len(g))) if g else c)
        moved = sum((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 for a, b in zip(centres, new))
        centres = new
        if moved < eta:
            break
    return centres


def py_stats(pts, centres, labels, spread):
    groups = {}
    for p in pts:
        groups.setdefault(py_nearest(p, centres), []).append(p)
    out = {}
    for k, g in groups.items():
        counts = {}
        for x, _ in g:
            counts[x] = counts.get(x, 0) + 1
        top_x = min(counts, key=lambda x: (-counts[x], x))
        ys = sorted(y for _, y in g)
        n = len(ys)
        med = ys[n // 2] if n % 2 else py_tdiv(ys[n // 2] + ys[n // 2 - 1], 2)
        out[k] = (labels[top_x // spread], float(counts[top_x] * 100 // n), n, med)
    return out


# -- unit behaviour ------------------------------------------------------------------

def test_nearest_ties_go_to_lowest_index(spark):
    df = C.assign(points(spark, [(5, 0), (10, 0), (15, 0), (30, 0)]), [(0, 0), (10, 0), (10, 0), (20, 0)])
    assert [r["k"] for r in df.orderBy("id").collect()] == [0, 1, 1, 3]


def test_means_truncate_toward_zero(spark):
    df = points(spark, [(0, -3), (1, -4), (0, 2), (1, 3)])
    assigned = df.withColumn("k", F.when(F.col("y") < 0, 0).otherwise(1))
    got = {r["k"]: (r["cx"], r["cy"], r["n"]) for r in C.centre_means(assigned).collect()}
    assert got == {0: (0, -3, 2), 1: (0, 2, 2)}


def test_step_keeps_empty_cluster_and_movement(spark):
    df = points(spark, [(0, 0), (2, 2)])
    centres = [(0, 0), (100, 100)]
    step = {r["k"]: (r["cx"], r["cy"]) for r in C.step_frame(df, centres).collect()}
    assert step == {0: (1, 1), 1: (100, 100)}
    assert C.step(df, centres) == [(1, 1), (100, 100)]
    mv = C.movement_frame(C.centres_frame(spark, centres), C.step_frame(df, centres)).collect()[0]["movement"]
    assert mv == 2 == C.movement(centres, [(1, 1), (100, 100)])


def test_kmeans_matches_brute_force(spark):
    rnd = random.Random(7)
    pts = [(rnd.randrange(4) * 1000, rnd.randrange(-50, 200)) for _ in range(600)]
    init = [pts[i] for i in range(8)]
    params = KMeansParams(spread=1000, k=8, eta=5.0, max_iter=30)
    res = C.kmeans(points(spark, pts), init, params)
    assert res.centres == py_kmeans(pts, init, 5.0, 30)
    assert len(res.history) <= 30
    assert res.converged == (res.history[-1][1] < 5.0)


def test_kmeans_fixed_rounds_when_eta_zero(spark):
    pts = [(0, 0), (0, 10), (1000, 0), (1000, 10)]
    res = C.kmeans(points(spark, pts), [(0, 0), (1000, 0)], KMeansParams(spread=1000, k=2, eta=0.0, max_iter=4))
    assert [h[0] for h in res.history] == [1, 2, 3, 4] and not res.converged
    assert res.centres == [(0, 5), (1000, 5)]


def test_cluster_stats_match_brute_force(spark):
    rnd = random.Random(11)
    labels = ("a", "b", "c")
    pts = [(rnd.randrange(3) * 100, rnd.randrange(-9, 9)) for _ in range(500)]
    centres = [(0, -5), (100, 0), (200, 5), (50, 50)]
    got = {r["k"]: (r["tag"], r["pct"], r["size"], r["median_score"])
           for r in C.cluster_stats(points(spark, pts), centres, Vocabulary(labels), 100).collect()}
    assert got == py_stats(pts, centres, labels, 100)


def test_cluster_stats_ties_and_even_median(spark):
    pts = [(0, -4), (100, -3)]      # one cluster, two tags tied, median -3.5
    got = C.cluster_stats(points(spark, pts), [(50, 0)], Vocabulary(("a", "b")), 100).collect()[0]
    assert (got["tag"], got["pct"], got["size"], got["median_score"]) == ("a", 50.0, 2, -3)


def test_report_line_layout(spark):
    stats = spark.createDataFrame([(0, "Scala", 66.0, 1200, 7)], "k int, tag string, pct double, size bigint, median_score bigint")
    line = C.cluster_report(stats).collect()[0]["line"]
    assert line == "%7d  %-17s (%-5.1f%%)      %7d" % (7, "Scala", 66.0, 1200)


# -- sampling --------------------------------------------------------------------------

def test_per_tag_sample_counts_and_indices(spark):
    pts = [(t * 1000, i) for t in range(3) for i in range(50)]
    s = S.sample_per_tag(points(spark, pts), KMeansParams(spread=1000, k=6), 3).collect()
    assert sorted(r["k"] for r in s) == list(range(6))
    assert all(r["k"] // 2 == r["x"] // 1000 for r in s)


def test_per_tag_sample_is_repeatable_and_order_free(spark):
    pts = [(t * 1000, i) for t in range(2) for i in range(200)]
    a = S.sample_per_tag(points(spark, pts), KMeansParams(spread=1000, k=4), 2)
    b = S.sample_per_tag(points(spark, pts).repartition(7), KMeansParams(spread=1000, k=4), 2)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_sample_checks(spark):
    pts = [(0, 1), (0, 2), (1000, 3)]
    with pytest.raises(ValueError):
        S.sample_per_tag(points(spark, pts), KMeansParams(spread=1000, k=3), 2)   # k not a multiple
    with pytest.raises(ValueError):
        S.seed_centres(points(spark, pts), KMeansParams(spread=1000, k=4), 2)     # a tag has too few


def test_global_sample_is_exact(spark):
    pts = [(i % 5, i) for i in range(100)]
    s = S.sample_global(points(spark, pts), 9, 42).collect()
    assert len(s) == 9 and sorted(r["k"] for r in s) == list(range(9))
    centres = S.seed_centres(points(spark, pts), KMeansParams(spread=10, k=9), 5)
    assert len(centres) == 9


def test_end_to_end_on_binding_matches_brute_force(spark):
    scored = P.question_max_score(B.postings(spark, SF_SMALL))
    v = P.tag_vectors(scored, B.POSTING_TAGS, 50000)
    params = KMeansParams(spread=50000, k=8, eta=20.0, max_iter=40, seed=42)
    init = S.seed_centres(v, params, len(B.POSTING_TAGS))
    res = C.kmeans(v, init, params)
    pts = [(r["x"], r["y"]) for r in v.collect()]
    assert res.centres == py_kmeans(pts, init, 20.0, 40)
    got = {r["k"]: (r["tag"], r["pct"], r["size"], r["median_score"])
           for r in C.cluster_stats(v, res.centres, B.POSTING_TAGS, 50000).collect()}
    assert got == py_stats(pts, res.centres, B.POSTING_TAGS.terms, 50000)
    assert sum(s[2] for s in got.values()) == len(pts)
    assert statistics.mean(s[1] for s in got.values()) > 0


def test_run_clustering_report(spark):
    scored = P.question_max_score(B.postings(spark, SF_SMALL))
    v = P.tag_vectors(scored, B.POSTING_TAGS, 50000)
    params = KMeansParams(spread=50000, k=8, eta=20.0, max_iter=40, seed=42)
    run = C.run_clustering(v, params, B.POSTING_TAGS)
    pts = [(r["x"], r["y"]) for r in v.collect()]
    assert run.fit.centres == py_kmeans(pts, S.seed_centres(v, params, 4), 20.0, 40)
    assert run.report[:3] == list(C.REPORT_HEADER)
    meds = [r["median_score"] for r in run.stats]
    assert meds == sorted(meds) and len(run.report) == 3 + len(run.stats)
    assert run.report[3] == "%7d  %-17s (%-5.1f%%)      %7d" % (
        run.stats[0]["median_score"], run.stats[0]["tag"], run.stats[0]["pct"], run.stats[0]["size"])


def test_weighted_points_give_the_same_statistics(spark):
    rnd = random.Random(5)
    pts = [(rnd.randrange(3) * 100, rnd.randrange(-4, 4)) for _ in range(400)]
    df = points(spark, pts)
    w = C.weighted_points(df)
    assert w.count() < len(pts) and w.agg(F.sum("w")).collect()[0][0] == len(pts)
    centres = [(0, 0), (100, 3), (200, -3)]
    a = sorted(map(tuple, C.cluster_stats(df, centres, Vocabulary(("a", "b", "c")), 100).collect()))
    b = sorted(map(tuple, C.cluster_stats(w, centres, Vocabulary(("a", "b", "c")), 100, weight="w").collect()))
    assert a == b
    assert C.step(df, centres) == C.step(w, centres, "w")


def test_clustering_does_not_depend_on_partitioning(spark):
    scored = P.question_max_score(B.postings(spark, SF_SMALL))
    v = P.tag_vectors(scored, B.POSTING_TAGS, 50000)
    params = KMeansParams(spread=50000, k=8, eta=20.0, max_iter=40, seed=42)
    a = C.run_clustering(v, params, B.POSTING_TAGS)
    b = C.run_clustering(v.repartition(7), params, B.POSTING_TAGS, checkpoint=False)
    assert a.fit.centres == b.fit.centres and a.fit.history == b.fit.history
    assert a.stats == b.stats and a.report == b.report


def test_kmeans_without_points_keeps_its_centres(spark):
    empty = points(spark, [])
    res = C.kmeans(empty, [(0, 0), (5, 5)], KMeansParams(spread=10, k=2, eta=1.0, max_iter=3))
    assert res.centres == [(0, 0), (5, 5)] and res.converged and res.history == [(1, 0)]
    assert C.cluster_stats(empty, res.centres, Vocabulary(("a",)), 10).count() == 0


def test_partitioned_points_give_the_same_fit(spark):
    rnd = random.Random(3)
    pts = [(rnd.randrange(4) * 1000, rnd.randrange(-50, 50)) for _ in range(300)]
    init = [pts[i] for i in range(6)]
    params = KMeansParams(spread=1000, k=6, eta=5.0, max_iter=20)
    single = C.kmeans(points(spark, pts), init, params)
    with C.kept_points(points(spark, pts).repartition(5)) as kept:
        plan = C.centre_means(kept.select("x", "y", "w", C.nearest(init).alias("k")), "w")._jdf \
            .queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(k" in plan and "Coalesce" not in plan
    assert "transform(" not in plan      # the distances are compiled, not interpreted
    partitioned = C.kmeans(points(spark, pts).repartition(5), init, params)
    assert single.centres == partitioned.centres == py_kmeans(pts, init, 5.0, 20)


def test_fitted_stats_read_the_checkpointed_points_not_the_tables(spark):
    # the session has a checkpoint folder (conftest): the statistics frame
    # reads the weighted points of the fit, not the postings join again
    p = B.POSTING_KMEANS_FIXED
    v = P.tag_vectors(P.question_max_score(B.postings(spark, SF_SMALL)), B.POSTING_TAGS, p.spread)
    stats = C.fitted_stats(v, p, B.POSTING_TAGS)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Join" not in plan
    assert "ExistingRDD" in plan
    seeds = S.seed_centres(v, p, len(B.POSTING_TAGS))
    expected = C.cluster_stats(v, C.kmeans(v, seeds, p).centres, B.POSTING_TAGS, p.spread)
    assert stats.collect() == expected.collect()


def test_seeded_points_read_the_checkpoint_and_agree_with_the_points(spark):
    p = B.POSTING_KMEANS_FIXED
    v = P.tag_vectors(P.question_max_score(B.postings(spark, SF_SMALL)), B.POSTING_TAGS, p.spread)
    points, seeds = C.seeded_points(v, p, len(B.POSTING_TAGS))
    assert seeds == S.seed_centres(v, p, len(B.POSTING_TAGS))
    step = C.step_frame(points, seeds, "w")
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "ExistingRDD" in plan
    assert sorted(step.collect()) == sorted(C.step_frame(v, seeds).collect())
    means = C.centre_means(C.assign(points, seeds), "w")
    assert sorted(means.collect()) == sorted(C.centre_means(C.assign(v, seeds)).collect())


def test_kmeans_parameters_defaults_and_checks():
    p = KMeansParams()
    assert (p.spread, p.k, p.eta, p.max_iter) == (50000, 45, 20.0, 120)
    for bad in ({"spread": 0}, {"k": 0}, {"max_iter": 0}):
        with pytest.raises(ValueError):
            KMeansParams(**bad)


# -- distributed median, search on lines, resumed fits ------------------------------

def plain_median(scores):
    s = sorted(scores)
    total = s[(len(s) - 1) // 2] + s[len(s) // 2]
    return abs(total) // 2 * (1 if total >= 0 else -1)


@pytest.mark.parametrize("ranges", [2, 3, 1 << 16])
def test_medians_by_running_counts(spark, ranges):
    import random
    rng = random.Random(ranges)
    rows = [(k, rng.choice([rng.randrange(-9, 9), rng.randrange(-1 << 62, 1 << 62), -(1 << 63), (1 << 63) - 1]), rng.randrange(1, 4))
            for k in range(12) for _ in range(rng.choice([1, 2, 9, 40]))]
    got = {r["k"]: r["median"] for r in C.medians(spark.createDataFrame(rows, "k int, y bigint, n bigint"), ranges).collect()}
    want = {k: plain_median([y for c, y, n in rows if c == k for _ in range(n)]) for k in range(12)}
    # a middle sum is taken in whole numbers of any size
    assert got == want
    assert C.medians(spark.createDataFrame([], "k int, y bigint, n bigint")).collect() == []


def test_median_of_ten_million_distinct_scores(spark):
    n, step, prime = 10_000_000, 100_003, 1_000_000_007      # i -> i * step mod prime: all different
    scores = spark.range(n).selectExpr("0 AS k", f"(id * {step}) % {prime} - 500000000 AS y", "1L AS n")
    import numpy as np
    y = np.sort(np.arange(n, dtype=np.int64) * step % prime - 500_000_000)
    total = int(y[(n - 1) // 2] + y[n // 2])
    assert C.medians(scores).first()["median"] == abs(total) // 2 * (1 if total >= 0 else -1)


@pytest.mark.parametrize("k", [1, 45, 5000])
def test_search_on_lines_finds_the_nearest_centre(spark, k):
    import random
    import numpy as np
    rng = random.Random(k)
    lines = [0, 50000, 100000, 150000]
    centres = [(rng.choice(lines + [rng.randrange(160000)]), rng.choice([rng.randrange(-50, 50), rng.randrange(-9000, 9000)]))
               for _ in range(k - k // 3)]
    centres += centres[:k // 3]                                # equal centres: the first one counts
    points = [(rng.choice(lines), rng.choice([rng.randrange(-60, 60), rng.randrange(-20000, 20000)])) for _ in range(1500)]
    c = np.array(centres, dtype=np.int64)
    want = [int(np.argmin((c[:, 0] - x) ** 2 + (c[:, 1] - y) ** 2)) for x, y in points]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x bigint, y bigint").coalesce(1)
    got = [r["k"] for r in C.assign(df, centres, lines).orderBy("id").collect()]
    assert got == want
    assert C.assign(df.selectExpr("7L AS x", "y"), centres, lines).where("k <> -1").count() == 0


def test_fit_with_many_centres_equals_the_plain_fit(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id % 4 * 50000 AS x", "id * 7919 % 1009 AS y")
    initial = [(i % 4 * 50000, i * 13 % 1000) for i in range(80)]
    p = KMeansParams(k=80, max_iter=4, eta=0.0)
    found = C.kmeans(df, initial, p)
    monkeypatch.setattr(C, "SEARCH_CENTRES", 100)
    assert C.kmeans(df, initial, p).history == found.history


def test_a_stopped_fit_goes_on_where_it_stopped(spark, scratch, monkeypatch):
    df = spark.range(2000).selectExpr("id % 4 * 50000 AS x", "id * 7919 % 1009 AS y")
    initial = [(i * 50000, 3 * i) for i in range(4)]
    p = KMeansParams(k=4, max_iter=8, eta=0.0)
    want = C.kmeans(df, initial, p)
    real, calls = C.step, []

    def breaks_in_the_fourth(*args):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("stopped")
        return real(*args)

    monkeypatch.setattr(C, "step", breaks_in_the_fourth)
    with pytest.raises(RuntimeError):
        C.kmeans(df, initial, p, resume=scratch)
    again = C.kmeans(df, initial, p, resume=scratch)
    assert (again.history, again.centres, again.converged) == (want.history, want.centres, want.converged)
    assert len(calls) == 4 + 5                                 # three rounds were read
    done = C.kmeans(df, initial, p, resume=scratch)
    assert done.history == want.history and len(calls) == 9
    with pytest.raises(ValueError, match="other initial centres"):
        C.kmeans(df, initial[::-1], p, resume=scratch)
