"""Sharding by a two-pass external shuffle.

Pass 1 scatters records uniformly into buckets that fit in memory, by a seeded
hash. Pass 2 shuffles every bucket with Fisher-Yates (Spark's own `shuffle`
on the bucket's array) and writes the buckets one after the other. The result
is one uniformly shuffled order of all records; cut into equal runs it gives
shards whose row counts differ by at most one (law `rows`).

Records that are equal in all key columns are counted before the scatter and
numbered, so that copies spread over the buckets like all other records. The
number of buckets comes from the record count; a bucket's array holds keys and
digests, never texts. A task holds up to BUCKETS_PER_TASK buckets beyond
LEAST_TASKS tasks. Offsets of buckets are one number per bucket, summed up in
groups of buckets first.

Defined results: a null text has no bytes and crc32 0; null ids are records
like others; repeated rows each get a place of their own; an empty table gives
an empty result; other columns are not read by the query, and are carried
along by `write_shards`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut

SHARDS = 24
SEED = 20
ROWS_PER_BUCKET = 4_096
BUCKETS_PER_TASK = 64
LEAST_TASKS = 256          # up to so many buckets have a task each
ROWS_PER_FILE = 65_536     # rows of a shard that one task writes
LAW = "rows"


def shuffled(records: DataFrame, keys: list[str], *, seed: int = SEED,
             rows_per_bucket: int = ROWS_PER_BUCKET, group: int = 4096) -> DataFrame:
    """One row per record of `records` (its `keys`), with `_pos`: its place
    in the shuffled order, 0 to the number of records - 1. The order depends
    on the records, the seed and the bucket size only."""
    counted = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.select(*keys, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    # known before the scatter: how many buckets of this size the records need
    n = records.count()
    buckets = max(1, math.ceil(n / rows_per_bucket))
    scattered = numbered.withColumn(
        "_bucket", F.pmod(F.xxhash64(F.lit(seed), *keys, "_copy"), F.lit(buckets)).cast("int"))
    # Each partition holds whole buckets in ascending order, each array is
    # sorted first: the same arrays meet the same random numbers on a retry.
    tasks = max(min(buckets, LEAST_TASKS), math.ceil(buckets / BUCKETS_PER_TASK))
    arrays = (scattered.repartition(tasks, "_bucket")
              .groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct(*keys, "_copy"))).alias("_recs"))
              .sortWithinPartitions("_bucket"))
    mixed = cut(arrays.select("_bucket", F.shuffle("_recs", F.lit(seed)).alias("_recs")))
    offsets = _running(mixed.select("_bucket", F.size("_recs").cast("bigint").alias("_size")), group)
    return (mixed.join(offsets, "_bucket")
            .select("_first", F.posexplode("_recs").alias("_i", "_r"))
            .select(*[F.col(f"_r.{k}").alias(k) for k in keys], (F.col("_first") + F.col("_i")).alias("_pos")))


def _running(sizes: DataFrame, group: int) -> DataFrame:
    """`_bucket, _first`: how many records lie in the buckets before. Sums run
    inside groups of buckets, and over the sums of the groups (a row each)."""
    def ahead(order: str, *within: str) -> Column:
        w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_size").over(w), F.lit(0))

    grouped = sizes.withColumn("_g", F.floor(F.col("_bucket") / group))
    groups = grouped.groupBy("_g").agg(F.sum("_size").alias("_size")).select("_g", ahead("_g").alias("_before"))
    return (grouped.select("_bucket", "_g", ahead("_bucket", "_g").alias("_in"))
            .join(groups, "_g").select("_bucket", (F.col("_before") + F.col("_in")).alias("_first")))


def cut_into_shards(placed: DataFrame, n_rows: int, shards: int = SHARDS) -> DataFrame:
    """Adds `shard` and `slot`: equal runs of the order, counts at most one
    apart, slots gapless from 0."""
    n, k = F.lit(max(1, n_rows)).cast("bigint"), F.lit(shards).cast("bigint")
    shard = F.expr(f"cast(_pos * {shards} div {max(1, n_rows)} as int)")
    first = (F.col("shard") * n + k - 1)
    return (placed.withColumn("shard", shard)
            .withColumn("_shard_first", first)
            .withColumn("slot", F.col("_pos") - F.expr(f"_shard_first div {shards}"))
            .drop("_shard_first"))


def assign(docs: DataFrame, shards: int = SHARDS, *, seed: int = SEED,
           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("bigint").alias("text_crc32"))
    narrow = cut(narrow)    # three numbers per document; texts are read once
    placed = shuffled(narrow, ["doc_id", "size", "text_crc32"], seed=seed, rows_per_bucket=rows_per_bucket)
    return cut_into_shards(placed, narrow.count(), shards).drop("_pos").withColumn("law", F.lit(LAW))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, *, seed: int = SEED,
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """Writes the documents, all columns, as Parquet folders `shard=0` ...; a
    shard is cut in runs of `rows_per_file` slots that different tasks may write,
    each in ascending `slot`. Rows that agree in doc_id and text share their
    places in any order."""
    text = F.coalesce("text", F.lit(""))
    key = {"_size": (F.octet_length(text) + 8).cast("bigint"), "_crc": F.crc32(F.encode(text, "UTF-8"))}
    same = Window.partitionBy("doc_id", "_size", "_crc").orderBy("text")
    places = assign(docs, shards, seed=seed).select(
        F.col("doc_id").alias("_doc_id"), F.col("size").alias("__size"), F.col("text_crc32").alias("__crc"),
        F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    nth = Window.partitionBy("_doc_id", "__size", "__crc").orderBy("_shard", "_slot")
    places = places.withColumn("__nth", F.row_number().over(nth))
    rows = (docs.select(F.struct("*").alias("_row"), "doc_id", "text").withColumns(key)
            .withColumn("_nth", F.row_number().over(same)))
    on = (rows["doc_id"].eqNullSafe(places["_doc_id"]) & (rows["_size"] == places["__size"])
          & (rows["_crc"] == places["__crc"]) & (rows["_nth"] == places["__nth"]))
    runs = max(1, math.ceil(docs.count() / shards / rows_per_file))
    out = (rows.join(places, on).select("_row", "_shard", "_slot")
           .repartition(shards * runs, "_shard", F.floor(F.col("_slot") / rows_per_file))
           .sortWithinPartitions("_shard", "_slot"))
    out.select(F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), "_row").write.partitionBy(
        "shard").mode("errorifexists").parquet(path)


def query(docs: DataFrame) -> DataFrame:
    return assign(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                               F.lit(None).cast("int").alias("grown_shard"))
