"""Session-level helpers: where to cut lineage, how to keep a reused frame."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or None
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Spark Connect) session: the server applies the setting
        return conf_dir
    found = sc.getCheckpointDir()
    if found:
        return found
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    return None


def keep(df: DataFrame, *, reliable: bool = True) -> DataFrame:
    """Keep a frame that several jobs read.

    The frame is persisted (memory, spilling to disk). When the session names a
    shared checkpoint folder and ``reliable`` is set, it is also written there
    with ``checkpoint()``, so that losing an executor re-reads the checkpoint
    instead of recomputing the lineage. Without such a folder, lost cached
    blocks are recomputed from lineage, which Spark does by itself.
    """
    spark = df.sparkSession
    if reliable and checkpoint_dir(spark):
        # One job computes the frame and writes it to the shared folder; the
        # first reader then fills the cache from the checkpoint files.
        return df.checkpoint(eager=True).persist(StorageLevel.MEMORY_AND_DISK)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()   # materialized now, so the frames it came from may be released
    return kept


def reread(df: DataFrame) -> DataFrame:
    """The frame written once to the session's shared checkpoint folder and
    read back from there, so that the jobs that read it later do not compute
    its lineage again (and a lost executor re-reads shared storage). The frame
    itself, unchanged, when the session names no folder. Nothing is cached, so
    nothing needs releasing."""
    return df.checkpoint(eager=True) if checkpoint_dir(df.sparkSession) else df


def shared_root(spark: SparkSession) -> str:
    """The folder for files that later jobs read: the session's checkpoint
    folder. A local session that names none has everything on one machine and
    uses that machine's temporary folder; a cluster session is refused."""
    folder = checkpoint_dir(spark)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.sparkContext._jvm.java.lang.System.getProperty("java.io.tmpdir")


_SCRATCH = "quarry-scratch"


def scratch_folder(spark: SparkSession) -> str:
    """A new name in the shared folder, for files that a query writes and reads
    back. They stay there until `clear_scratch`: frames made from them are read
    later, so only the caller knows when they are done with."""
    return f"{shared_root(spark)}/{_SCRATCH}-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written once as Parquet into the shared folder and read back:
    what its rows and their partitions were then holds for every later reader,
    also where computing them again could deal them differently."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Deletes what `scratch_folder` gave to this application. Frames that read
    those files fail afterwards. True if there was anything."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{_SCRATCH}-{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sql_literal(value) -> str:
    """A SQL literal for a driver value. Text goes in as UTF-8 bytes in hex,
    so no quoting or escaping rule (or parser setting) can change it."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        # the least bigint has no literal of its own
        return f"{value}L" if abs(value) < 1 << 63 else f"CAST('{value}' AS DECIMAL(38,0))"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, str):
        return f"CAST(X'{value.encode('utf-8').hex()}' AS STRING)"
    raise TypeError(f"unsupported value {value!r}")


def local_table(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A small table from driver values (parameters such as a vocabulary or k
    centres, never data): SQL `VALUES` of literals, so it plans as a local
    relation (collected without a job) and builds in time linear in its rows.
    Columns map name -> SQL type."""
    names = list(columns)
    if any(len(r) != len(names) for r in rows):
        raise ValueError("every row needs one value per column")
    body = rows or [tuple(None for _ in names)]
    values = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in body)
    cols = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in columns.items())
    where = "" if rows else " WHERE false"
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(f'`{n}`' for n in names)}){where}")
