"""Every registered query against its SQL in DuckDB (as the driver checks at
sf0.01, here on sf0.001 to stay quick), and plan-shape rules for all of them."""

import collections
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from test_skew import conf
from quarry.plans.oracle import oracle_sql
from quarry.plans.registry import queries
from quarry.sources import bindings as B
from quarry.sources.bindings import TABLES

QUERIES = queries()
SQL = oracle_sql()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) >= 31


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["term", "n"] and len(rows) == 15


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = df.collect()
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert multiset(df.columns, srows) == multiset(dcols, drows)


# Plan rules: no cartesian or nested-loop joins, no Python evaluation, and no
# broadcast of anything but parameter-sized tables (none is hinted at all in
# the registered queries except through Spark's own size-based choice).
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name, broadcast):
    """Also with Spark's own broadcasts off, as for tables of any size."""
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": broadcast}):
        df = QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"
    if "Aggregate" in plan:
        # a shuffled aggregation is split into a partial (map-side) and a final step
        assert "partial_" in plan, f"{name} has no partial aggregation"


def test_the_ranking_from_the_index_builds_no_arrays(spark):
    plan = QUERIES["term_rank_from_index"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_the_fit_stops_before_its_round_limit(spark):
    rounds = QUERIES["kmeans_history"](spark, SF_SMALL).orderBy("iter").collect()
    p = B.POSTING_KMEANS
    assert 1 <= len(rounds) < p.max_iter and rounds[-1]["movement"] < p.eta
    assert all(r["movement"] >= p.eta for r in rounds[:-1])


def test_assignment_is_compiled(spark):
    from quarry.operators import clustering
    points = spark.range(1000).selectExpr("id AS x", "id % 7 AS y").repartition(4)
    plan = clustering.assign(points, [(i, i) for i in range(45)])._jdf.queryExecution()
    tree = plan.executedPlan().toString()
    assert "array_min" in tree and "Coalesce 1" not in tree
    from contextlib import redirect_stdout
    import io
    out = io.StringIO()
    with conf(spark, **{"spark.sql.adaptive.enabled": "false"}), redirect_stdout(out):
        clustering.assign(points, [(i, i) for i in range(45)]).explain("codegen")
    assert "array_min" in out.getvalue()


def test_per_tag_sample_limits_before_the_shuffle(spark):
    plan = QUERIES["seed_sample_per_tag"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
