"""Mixing sources to target weights by Pfair scheduling.

Each source's documents form blocks. Block k (from 1) of a source with weight
w is released at slot floor((k - 1) / w) and due at slot ceil(k / w). Filling
one slot after the other with the released block that is due first keeps every
source, at every slot, within less than one block of weight x slots.

Weights are taken as given, as exact fractions: nothing is rounded to a period,
so the bound holds against the target weights however long the run is. The
driver schedules one block after the other, over all blocks there are (by
default a 16th of the documents), and holds only one piece of the schedule: rows
of CHUNK blocks of one source, of which PIECE blocks at a time are written to
the shared folder when there are more. Documents find their slot by a join with
these rows and a look-up.

Within a source the order is random but seeded. Documents are ranked inside
(source, part) groups, parts being a hash of the document, and the ranks are
lifted by the sizes of the parts before: a source with a third of all rows is
ranked by many tasks.

All documents are kept. Once a source has run out the others go on, each block
still inside its own window; a slot for which no block is released stays empty.
So a source keeps the bound until it has run out itself.

Defined results: a null source is a source of its own; a null doc_id is a
document like others; repeated rows are ranked one after the other; an empty
table gives an empty result; a weight that is not above 0 is refused, because
its documents would never be released; a column of any name other than source and doc_id
(and text, which only breaks ties) is carried along untouched.
"""

from __future__ import annotations

import heapq
import math
import uuid
from array import array
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, ensure_checkpoint_dir
from quarry.session import checkpoint_dir

SEED = 5
BLOCK = 16             # documents in a block
PERIOD = 1000          # slots in a period of `slots_of`
CHUNK = 1024           # blocks of a source in a row of the schedule
PIECE = 1 << 20        # blocks of the schedule held on the driver, or broadcast
ROWS_PER_PART = 2000
TEMPERATURE = 0.5      # default weights: source size to this power


def slots_of(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Weights rounded to whole slots per period, by largest remainders, one at
    least: for callers who want a short period. `interleave` does not round."""
    period = max(period, 4 * len(weights))
    total = math.fsum(weights.values())
    exact = {s: Fraction(w) / Fraction(total) * period for s, w in weights.items()}
    got = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    left = period - sum(got.values())
    for i in range(max(0, left)):
        got[by_rest[i % len(by_rest)]] += 1
    while sum(got.values()) > period:      # only after raising sources to one slot
        got[max(got, key=lambda s: (got[s], s))] -= 1
    return got


def timetable(weights: dict[str, float], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int]]:
    """(source, slot, release, deadline) of all blocks, by slot; those of a
    source come in their order. Earliest deadline first among released blocks;
    the name breaks ties. Exact: whole numbers in the proportion of the weights."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = math.lcm(*[x.denominator for x in exact.values()])
    share = {s: int(x * unit) for s, x in exact.items()}
    total = sum(share.values())
    waiting = [(0, s, 1) for s in sorted(share) if blocks[s]]      # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []                    # deadline, source, block, release
    t = 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            release, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-k * total // share[s]), s, k, release))
        deadline, s, k, release = heapq.heappop(ready)
        yield s, t, release, deadline
        if k < blocks[s]:
            heapq.heappush(waiting, (k * total // share[s], s, k + 1))
        t += 1


def schedule(slots: dict[str, int]) -> dict[str, list[int]]:
    """source -> the slots it gets, ascending, in one period of weights that
    are whole numbers of slots."""
    got: dict[str, list[int]] = {s: [] for s in slots}
    for s, t, _, _ in timetable(slots, slots):
        got[s].append(t)
    return got


def source_key(source: Column) -> Column:
    """A non-null key: a null source differs from every text."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source.cast("string")))


def default_weights(sizes: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, float]:
    return {s: n**temperature for s, n in sizes.items()}


_ARRAYS = ("_at", "_from", "_due")
_PLAN = pa.schema([("_src", pa.string()), ("_chunk", pa.int64()), *[(c, pa.list_(pa.int64())) for c in _ARRAYS]])


def _plan_rows(weights: dict[str, float], blocks: dict[str, int], chunk: int) -> Iterator[tuple]:
    """The timetable by source and chunk of its blocks: slots, releases, deadlines."""
    held = {s: tuple(array("q") for _ in _ARRAYS) for s in blocks}
    done = dict.fromkeys(blocks, 0)
    for s, *times in timetable(weights, blocks):
        for column, x in zip(held[s], times):
            column.append(x)
        if len(held[s][0]) == chunk:
            yield s, done[s], *held[s]
            held[s], done[s] = tuple(array("q") for _ in _ARRAYS), done[s] + 1
    for s, columns in held.items():
        if columns[0]:
            yield s, done[s], *columns


def _plan_table(spark: SparkSession, weights: dict[str, float], blocks: dict[str, int], chunk: int,
                piece: int) -> DataFrame:
    """One row per source and chunk of its blocks. Up to `piece` blocks it is a
    local table and broadcast; more are written piece by piece and joined as
    Spark sees fit."""
    def frame(rows: list[tuple]) -> DataFrame:
        columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_PLAN), _PLAN)]
        return spark.createDataFrame(pa.Table.from_arrays(columns, schema=_PLAN))

    rows = _plan_rows(weights, blocks, chunk)
    if sum(blocks.values()) <= piece:
        return F.broadcast(frame(list(rows)))
    ensure_checkpoint_dir(spark)
    path = f"{checkpoint_dir(spark)}/quarry-{uuid.uuid4().hex}"
    part: list[tuple] = []
    n = 0
    for row in rows:
        part.append(row)
        n += len(row[2])
        if n >= piece:
            frame(part).write.mode("append").parquet(path)
            part, n = [], 0
    out = frame(part)
    out.write.mode("append").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def interleave(docs: DataFrame, weights: dict[str | None, float] | None = None, *, block: int = BLOCK,
               seed: int = SEED, rows_per_part: int = ROWS_PER_PART, chunk: int = CHUNK,
               piece: int = PIECE) -> DataFrame:
    """All rows as a struct `_row`, with `_src`, `_rank` (0 up, within the
    source), `_block` (1 up), `_release`, `_deadline` and `_slot` (in blocks).
    Sorted by (_slot, _rank) they are the mix. `weights` by source; sources
    not named, or all when None, weigh size ** TEMPERATURE."""
    spark = docs.sparkSession
    keyed = docs.select(F.struct("*").alias("_row"), source_key(F.col("source")).alias("_src"),
                        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("_h"))
    sizes = {r["_src"]: r["n"] for r in keyed.groupBy("_src").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = max(1, math.ceil(sum(sizes.values()) / rows_per_part))
    goal = default_weights(sizes)
    if weights:
        named = {"-" if s is None else f"+{s}": w for s, w in weights.items()}
        goal |= {s: w for s, w in named.items() if s in goal}
    blocks = {s: -(-n // block) for s, n in sizes.items()}

    keyed = keyed.withColumn("_part", F.pmod(F.col("_h"), F.lit(parts)).cast("int"))
    in_part = Window.partitionBy("_src", "_part").orderBy("_h", "_row.doc_id")
    ranked = keyed.withColumn("_i", F.row_number().over(in_part) - 1)
    # (source, part) sizes: parts rows per source, summed up within the source
    groups = keyed.groupBy("_src", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_src").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = groups.select("_src", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    placed = (ranked.join(firsts, ["_src", "_part"])
              .withColumn("_rank", F.col("_first") + F.col("_i"))
              .withColumn("_block", F.floor(F.col("_rank") / block) + 1))
    at = (F.pmod(F.col("_block") - 1, F.lit(chunk)) + 1).cast("int")
    return (placed.withColumn("_chunk", F.expr(f"(_block - 1) div {chunk}"))
            .join(_plan_table(spark, goal, blocks, chunk, piece), ["_src", "_chunk"])
            .select("_row", "_src", "_rank", "_block", F.element_at("_from", at).alias("_release"),
                    F.element_at("_due", at).alias("_deadline"), F.element_at("_at", at).alias("_slot")))


def query(docs: DataFrame) -> DataFrame:
    """One row per document: its source, place within the source, block,
    window of the block and slot of the mix."""
    mixed = interleave(_narrow(docs))
    return mixed.select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"),
        F.col("_rank").cast("bigint").alias("source_rank"), F.col("_block").cast("bigint").alias("block"),
        F.col("_release").cast("bigint").alias("release"), F.col("_deadline").cast("bigint").alias("deadline"),
        F.col("_slot").cast("bigint").alias("slot"))


def _narrow(docs: DataFrame) -> DataFrame:
    """doc_id, source and a hash in the text's place, which is enough to
    order the documents; written once, so texts are read once."""
    return cut(docs.select("doc_id", "source", F.xxhash64("text").alias("text")))


def stage(docs: DataFrame) -> DataFrame:
    """The documents in the order of the mix: contiguous runs of it per
    partition, in partition order. `placed` reads the order back from the files."""
    mixed = interleave(docs)
    ordered = mixed.repartitionByRange("_slot", "_rank").sortWithinPartitions("_slot", "_rank")
    return ordered.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def placed(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and `place`, the row's position (0 up) in the order in
    which `docs` is stored: by part file and row in it, however Spark deals the
    files to tasks. A frame that is not read from files has the order of its
    partitions."""
    try:
        meta = docs.metadataColumn("_metadata")
        keyed = docs.select("doc_id", "text", meta["file_path"].alias("_file"), meta["row_index"].alias("_at"))
        name = F.regexp_extract(F.element_at(F.split("_file", "/"), -1), r"^part-(\d+)", 1)
        order = [F.length(name), name, F.col("_file")]     # part numbers of any length
    except AnalysisException:
        at = F.monotonically_increasing_id()
        keyed = docs.select("doc_id", "text", F.spark_partition_id().alias("_file"),
                            at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
        order = [F.col("_file")]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (keyed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))      # one row per file
              .select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first")))
    return keyed.join(F.broadcast(firsts), "_file").select("doc_id", "text", (F.col("_first") + F.col("_at")).alias("place"))
