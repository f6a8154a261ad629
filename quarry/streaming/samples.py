"""The seed sample of points that keep arriving.

The points of a tag with the m least hashes are a bounded sample that merges: of
two sets of points it is the sample of their samples together. So every batch
is reduced with the sample before it, m rows a tag, and what is kept does not
grow with the stream. After any number of batches, in any order, the sample is
the one `sampling.sample_per_tag` draws from all points at once.

The sample after a batch is written under the batch's number, and a batch that
is run again (after a failure) starts from the sample before it and writes the
same rows, so no point is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.sampling import sample_per_tag
from quarry.params import KMeansParams

_POINTS = "id bigint, x bigint, y bigint"


def _batches(spark: SparkSession, folder: str) -> dict[int, str]:
    """Committed samples by batch number."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/batch-*/_SUCCESS")) or []:
        name = status.getPath().getParent().getName()
        found[int(name.removeprefix("batch-"))] = f"{folder}/{name}"
    return found


def merge_batch(points: DataFrame, batch: int, folder: str, params: KMeansParams, n_tags: int) -> None:
    """Writes the sample after a batch of points (`id, x, y`)."""
    spark = points.sparkSession
    before = {n: path for n, path in _batches(spark, folder).items() if n < batch}
    both = points.select("id", "x", "y")
    if before:
        both = both.unionByName(spark.read.schema(_POINTS).parquet(before[max(before)]))
    (sample_per_tag(both, params, n_tags).select("id", "x", "y")
     .write.mode("overwrite").parquet(f"{folder}/batch-{batch:012d}"))


def read_sample(spark: SparkSession, folder: str, params: KMeansParams, n_tags: int) -> DataFrame:
    """`k, id, x, y` as `sample_per_tag` gives them, after the last whole batch."""
    done = _batches(spark, folder)
    if not done:
        raise ValueError(f"no sample in {folder}")
    return sample_per_tag(spark.read.schema(_POINTS).parquet(done[max(done)]), params, n_tags)


def sample_stream(points: DataFrame, folder: str, checkpoint: str, params: KMeansParams, n_tags: int):
    """Starts keeping the sample of a stream of points; returns the query."""
    def each(batch_points: DataFrame, batch: int) -> None:
        merge_batch(batch_points, batch, folder, params, n_tags)

    return (points.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
