"""Bench: the headline queries of the three programs at $BENCH_SF_DIR on
local[$BENCH_CPUS]. Prints one JSON line.

Small results are collected; large ones are written to the `noop` sink so the
whole result is computed without moving it to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from quarry.operators import clustering, postings  # noqa: E402
from quarry.plans.registry import queries  # noqa: E402
from quarry.sources import bindings as B  # noqa: E402


def session(cpus: int) -> SparkSession:
    builder = SparkSession.builder
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:   # stage and task times for scripts/eventlog_summary.py
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
    spark = (builder.master(f"local[{cpus}]")
             .appName("quarry-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame | None, big: bool) -> None:
    if df is None:
        return
    if big:
        df.write.format("noop").mode("overwrite").save()
    else:
        df.collect()


def clustering_program(spark: SparkSession, sf_dir: str) -> None:
    """Postings -> best scores -> vectors -> seeds -> k-means (eta 20, up to
    120 rounds) -> cluster report, as the reference's main program (the
    report's k lines come back to the driver inside the run)."""
    p = B.POSTING_KMEANS
    v = postings.tag_vectors(postings.question_max_score(B.postings(spark, sf_dir)), B.POSTING_TAGS, p.spread)
    run = clustering.run_clustering(v, p, B.POSTING_TAGS)
    assert len(run.report) == len(clustering.REPORT_HEADER) + len(run.stats)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = session(cpus)
    q = queries()
    # (name, callable, large result?)
    plan = [
        ("term_rank_zero_filled", q["term_rank_zero_filled"], False),
        ("term_rank_from_index", q["term_rank_from_index"], False),
        ("term_rank_one_pass", q["term_rank_one_pass"], False),
        ("term_index", q["term_index"], True),
        ("page_line_parse", q["page_line_parse"], True),
        ("posting_line_parse", q["posting_line_parse"], True),
        ("qa_pairs", q["qa_pairs"], True),
        ("question_max_score", q["question_max_score"], True),
        ("tag_score_vectors", q["tag_score_vectors"], True),
        ("kmeans_fit_5_rounds", q["kmeans_fit"], False),
        ("clustering_program", clustering_program, False),
        ("wide_read", q["wide_read"], True),
        ("summary_grouped", q["summary_grouped"], False),
        ("summary_grouped_sql", q["summary_grouped_sql"], False),
        ("summary_grouped_typed", q["summary_grouped_typed"], False),
    ]
    # Warm-up (not timed): JVM start, file listing, code generation paths.
    for t in ("documents", "orders", "lineitem"):
        B.table(spark, sf_dir, t).count()
    times: dict[str, float] = {}
    for name, fn, big in plan:
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        consume(fn(spark, sf_dir), big)
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
