import os

import pytest

from quarry.params import Vocabulary
from quarry.sources.articles import MARKER
from quarry.streaming import term_counts_stream


def test_term_counts_over_arriving_files(spark, scratch):
    folder = os.path.join(scratch, "in")
    os.makedirs(folder)

    def drop(name, texts):
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(f"<page> <title>t{MARKER}{t}</text> </page> " for t in texts) + "\n")

    drop("a.txt", ["Scala compiles slowly", "Some Java calls Scala code OK,"])
    counts = term_counts_stream(spark, folder, Vocabulary(("Scala", "Java", "Groovy")), max_files_per_trigger=1)
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("term_counts_test")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).start())
    try:
        q.processAllAvailable()
        first = {r["term"]: r["n"] for r in spark.sql("SELECT * FROM term_counts_test").collect()}
        assert first == {"Scala": 2, "Java": 1}
        drop("b.txt", ["Groovy and Java", "Java"])
        q.processAllAvailable()
        second = {r["term"]: r["n"] for r in spark.sql("SELECT * FROM term_counts_test").collect()}
        assert second == {"Scala": 2, "Java": 3, "Groovy": 1}
    finally:
        q.stop()


def test_sample_of_a_stream_is_the_sample_of_all_points(spark, scratch):
    from quarry.operators.sampling import sample_per_tag
    from quarry.params import KMeansParams
    from quarry.streaming.samples import merge_batch, read_sample, sample_stream
    p = KMeansParams(k=12)
    points = spark.range(5000).selectExpr("id", f"id % 4 * {p.spread} AS x", "id * 37 % 101 AS y")
    want = sorted(tuple(r) for r in sample_per_tag(points, p, 4).collect())
    for n in range(3):
        points.where(f"id % 3 = {n}").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = (spark.readStream.schema("id bigint, x bigint, y bigint").option("maxFilesPerTrigger", 1)
              .parquet(f"{scratch}/in"))
    query = sample_stream(stream, f"{scratch}/out", f"{scratch}/checkpoint", p, 4)
    assert query.awaitTermination(120) and len(query.recentProgress) >= 3
    got = read_sample(spark, f"{scratch}/out", p, 4)
    assert sorted(tuple(r) for r in got.collect()) == want
    # a batch that is run again changes nothing
    merge_batch(points.where("id % 3 = 2"), 2, f"{scratch}/out", p, 4)
    assert sorted(tuple(r) for r in read_sample(spark, f"{scratch}/out", p, 4).collect()) == want
    with pytest.raises(ValueError, match="no sample"):
        read_sample(spark, f"{scratch}/none", p, 4)
