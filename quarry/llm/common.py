"""What several operators of this subpackage share: the word pattern, reading
a table, and where lineage is cut."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

# White space of the word definition, as characters: a word is a longest run
# of anything else.
SPACES = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order (null: an empty array)."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)),
                      F.array().cast("array<string>"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder the session names in `spark.checkpoint.dir`. A scratch
    folder is set only for a local session that names none (tests); a cluster
    session without a folder is refused, because its executors share no disk."""
    if checkpoint_dir(spark):
        return
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))


def cut(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The frame computed once and read back from the shared checkpoint
    folder: later jobs, and retries after a lost executor, read the files.
    `partitions`, for frames whose size is known or bounded: at most so many
    tasks write it, so that small frames are not spread over many files."""
    ensure_checkpoint_dir(df.sparkSession)
    return (df.coalesce(partitions) if partitions else df).checkpoint(eager=True)


def few(spark: SparkSession) -> int:
    """Partitions for results that are much smaller than the documents: four
    for each core of the cluster."""
    return 4 * spark.sparkContext.defaultParallelism


def store(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Like `cut`, in Parquet: for wide results of which later jobs read some
    columns. The files lie in the shared checkpoint folder and stay there."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{checkpoint_dir(spark)}/quarry-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets the files of shuffles go that no frame needs any more. Spark removes them
    when the driver collects its garbage, which with little of it may come too late
    for the disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Gives back to the system what this process has freed, where its allocator
    can: Python workers wait for their next task with the memory of the last."""
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)
