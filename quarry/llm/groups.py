"""Finding near pairs without emitting them all: buckets, components, blocks.

Near-duplicate operators go through the same steps. Items that share a bucket
are compared by a few bit words each, and every bucket yields a spanning
forest of its near pairs, never the pairs themselves. The connected components
of all forests hold every candidate pair inside one component. Components are
then compared pair by pair with all the data an exact check needs, in blocks
of bounded size: a component of more than a block's items is split in parts,
and every two parts meet in one block, so no pair is left out and no task or
array ever holds an unbounded group.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, few, trim

COARSE = 1 << 18         # buckets are counted in so many classes of keys
EDGES_PER_TASK = 100_000
BUCKET_ROWS = 4096       # a bucket of more rows is compared part by part
SKETCH_ROWS = 1 << 16    # a bucket of more rows with sketches is dealt out by their bytes
AT_ONCE = 1 << 18        # pairs that are compared at once
BYTES = 1 << 23          # of whole blocks that are compared together, about
LARGE_BROADCAST = 100_000   # components of more than a block that are broadcast


# Groups of a sorted stream ---------------------------------------------------------

def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, each as one table. Runs of one row
    are left out. Rows must come sorted by the keys, which are 64-bit numbers."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        turn = np.zeros(t.num_rows - 1, dtype=bool)
        for k in keys:
            v = t.column(k).to_numpy()
            turn |= v[1:] != v[:-1]
        begin = np.concatenate(([0], np.flatnonzero(turn) + 1))
        size = np.diff(begin)
        for i in np.flatnonzero(size > 1):
            yield t.slice(begin[i], size[i])
        rest = t.slice(begin[-1])
    if rest is not None and rest.num_rows > 1:
        yield rest


def pairs_of_parts(part: Column, parts: Column) -> Column:
    """The blocks that a row of part `part` (of `parts`) goes to: one for
    every two parts; the only block when there is one part."""
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), parts - 1), lambda j: j != part)
    return F.when(parts <= 1, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.transform(others, lambda j: F.least(part, j) * parts + F.greatest(part, j)))


# Buckets -------------------------------------------------------------------------

def distances(bits: np.ndarray, i: int) -> np.ndarray:
    """Hamming distance of row i of `bits` (rows x 64-bit words) to all rows."""
    return np.bitwise_count(bits ^ bits[i]).sum(axis=1, dtype=np.int64)


def forest(bits: np.ndarray, most: int | Callable) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of rows at most `most` bits apart, or of
    those that most(rows, rows), by broadcasting, says are near. Every row is
    compared with all at most once."""
    alike = most if callable(most) else (
        lambda x, y: np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64) <= most)
    n = len(bits)
    a: list[int] = []
    b: list[int] = []
    if n <= 128:      # all at once: most buckets hold no near pair
        near = alike(bits[:, None, :], bits[None, :, :])
        if np.count_nonzero(near) == n:
            return a, b
    left = np.ones(n, dtype=bool)
    for start in range(n):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            i = todo.pop()
            hit = np.flatnonzero(left & (near[i] if n <= 128 else alike(bits, bits[i])))
            left[hit] = False
            a += [i] * len(hit)
            b += hit.tolist()
            todo += hit.tolist()
    return a, b


def bucket_edges(rows: DataFrame, bits: list[str], most: int | Callable,
                 bucket_rows: int | None = None, sketch: str | None = None, same: int = 0,
                 close: Callable | None = None) -> DataFrame:
    """Edges `a, b` between ids that connect, for every `key`, what the pairs of its
    rows connect that are near (see `forest`): no more edges than rows. `rows`:
    key, id, bits (all bigint).

    `sketch` names one of the bits: eight bytes, of which near rows have at least
    `same` equal, and the rows of a bucket that of number `key` mod 8. A large
    bucket falls into smaller ones then, by one byte more: of `same` equal bytes one
    is among any 9 - `same` others. Its rows are written that many times at most,
    whatever its size, not once for every two parts of it. `close` says, of the first
    bits alone, which rows may be near."""
    bucket_rows = bucket_rows or (SKETCH_ROWS if sketch else BUCKET_ROWS)
    coarse = F.pmod(F.col("key"), F.lit(COARSE))
    # at most COARSE rows, so it may be broadcast: classes whose buckets may be large
    large = (rows.groupBy(coarse.alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > bucket_rows)
             .select("_c", F.ceil(F.col("_n") / bucket_rows * 2).alias("_parts")))
    spread = rows.withColumn("_c", coarse).join(F.broadcast(large), "_c", "left")
    parts = F.coalesce("_parts", F.lit(1)).cast("bigint")
    if sketch:
        blocks = byte_keys(F.col(sketch), F.call_function("shiftleft", F.lit(1), F.pmod("key", F.lit(8)).cast("int")), same, F.col("key"))["block"]
    else:
        blocks = pairs_of_parts(F.pmod(F.xxhash64("id"), parts), parts)
    block = F.explode_outer(F.when(parts > 1, blocks)).alias("_block")
    # one number to sort by: that of a bucket that is compared part by part is another for each block
    key = F.when(F.col("_block").isNull(), F.col("key")).otherwise(F.xxhash64("key", "_block")).alias("key")
    dealt = (spread.select("key", "id", *bits, block).select(key, "id", *bits)
             .repartition("key").sortWithinPartitions("key"))

    alike = most if callable(most) else (
        lambda x, y: np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64) <= most)
    column = bits.index(sketch) if sketch else None

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for key, ids, words in _whole_groups(batches, bits):
            begin = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            size = np.diff(begin)
            two = begin[:-1][size == 2]        # most groups: all at once
            two = two[alike(words[two], words[two + 1])]
            a, b = [ids[two]], [ids[two + 1]]
            stars = (_stars(words, begin[:-1], size, alike) if column is None
                     else [spanning(*map(np.concatenate, zip(*_refined(words, begin[:-1], size, alike, column, same, close))))])
            for i, j in stars:
                a.append(ids[i])
                b.append(ids[j])
            for at in range(0, sum(map(len, a)), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)[at:at + 50_000]) for x in (a, b)], ["a", "b"])
        trim()

    return dealt.mapInArrow(find, "a bigint, b bigint")


def byte_keys(sketch: Column, agreed: Column, same: int, block: Column) -> Column:
    """An array of `block, agreed` for a row of a block whose rows have equal bytes
    where the bits of `agreed` are set: smaller blocks, of rows with one byte more
    equal, in which every two rows meet that have `same` equal ones."""
    places = F.slice(F.filter(F.array(*map(F.lit, range(8))),
                              lambda p: F.call_function("getbit", agreed.cast("bigint"), p) == 0), 1, 9 - same)
    return F.transform(places, lambda p: F.struct(
        F.xxhash64(block, p, F.call_function("shiftrightunsigned", sketch, p * 8).bitwiseAND(F.lit(255))).alias("block"),
        agreed.bitwiseOR(F.call_function("shiftleft", F.lit(1), p)).alias("agreed")))


def _stars(words: np.ndarray, begin: np.ndarray, size: np.ndarray, alike: Callable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what the near pairs connect in each group of three rows or
    more: small groups of one size are compared all at once."""
    for n in np.unique(size[(size > 2) & (size <= 128)]).tolist():
        same = begin[size == n]
        for at in range(0, len(same), step := max(1, AT_ONCE // (n * n))):
            some = same[at:at + step]
            rows = words[some[:, None] + np.arange(n)]
            near = alike(rows[:, :, None, :], rows[:, None, :, :])
            hit = np.count_nonzero(near, axis=(1, 2)) > n
            near, some = near[hit], some[hit]
            least = near.argmax(axis=2)          # the least row that each is near to, itself too,
            while len(some):
                lower = np.where(near, least[:, None, :], n).min(axis=2)      # and so on
                if np.array_equal(lower, least):
                    break
                least = lower
            group, row = np.nonzero(least != np.arange(n))
            yield some[group] + least[group, row], some[group] + row
    for k in np.flatnonzero(size > 128).tolist():
        rows = words[begin[k]:begin[k] + size[k]]
        some = max(1, AT_ONCE // len(rows))
        partner = np.concatenate([np.count_nonzero(alike(rows[at:at + some, None, :], rows[None, :, :]), axis=1) > 1
                                  for at in range(0, len(rows), some)])
        at = begin[k] + np.flatnonzero(partner)
        i, j = forest(rows[partner], alike)
        yield at[i], at[j]


def _refined(words: np.ndarray, begin: np.ndarray, size: np.ndarray, alike: Callable, sketch: int,
             same: int, close: Callable | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs that connect what all near pairs of the groups of three rows or
    more connect. Rows of a group of more than 128 are compared where one more byte
    of their sketches is equal, until `same` are."""
    none = np.zeros(0, dtype=np.int64)
    yield none, none
    first_bits = np.ascontiguousarray(words[:, 0])

    def places(some: np.ndarray) -> np.ndarray:
        n = size[some]
        return np.repeat(begin[some] - np.cumsum(n) + n, n) + np.arange(n.sum())

    def pairs(rows: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, j in _pairs(rows, n):
            if close is not None:
                maybe = close(first_bits[i], first_bits[j])
                i, j = i[maybe], j[maybe]
            near = alike(words[i], words[j])
            yield i[near], j[near]

    few = (size > 2) & (size <= 128)
    yield from pairs(places(few), size[few])
    todo = [(places(size > 128), size[size > 128])] if (size > 128).any() else []
    while todo:
        rows, size = todo.pop()
        first, group = np.cumsum(size) - size, np.repeat(np.arange(len(size)), size)
        marks = words[rows, sketch]
        differ = np.bitwise_or.reduceat(marks ^ marks[first][group], first)
        equal = differ.view(np.uint8).reshape(-1, 8) == 0      # the lowest byte first
        ready = equal.sum(axis=1) >= same
        for k in np.flatnonzero(ready).tolist():
            yield from _tree(words, rows[first[k]:first[k] + size[k]], alike)
        order_of = np.argsort(equal, axis=1, kind="stable")      # those that differ come first
        keep = ~ready[group]
        rows, group, marks = rows[keep], group[keep], marks[keep]
        for slot in range(9 - same if len(rows) else 0):
            byte = marks >> (order_of[group, slot] * 8).astype(np.uint64) & np.uint64(255)
            key = group << 8 | byte.astype(np.int64)
            order = np.argsort(key, kind="stable")
            key, own = key[order], rows[order]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n = np.diff(np.append(at, len(key)))
            n_of = np.repeat(n, n)
            few = (n_of > 1) & (n_of <= 128)
            yield from pairs(own[few], n[(n > 1) & (n <= 128)])
            if (n > 128).any():
                todo.append((own[n_of > 128], n[n > 128]))


def _pairs(rows: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of small groups, which stand one after the other in `rows`."""
    later = np.repeat(np.cumsum(size), size) - np.arange(len(rows)) - 1      # rows of the same group behind each
    upto = np.cumsum(later)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + AT_ONCE, side="right")))
        some = later[at:to]
        i = np.repeat(np.arange(at, to), some)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some)
        yield rows[i], rows[j]
        at = to


def _tree(words: np.ndarray, rows: np.ndarray, alike: Callable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A forest of the near pairs among `rows`: each is compared with those that
    nothing has been near to so far."""
    todo: list[int] = []
    while len(rows):
        if not todo:
            todo, rows = [int(rows[0])], rows[1:]
        i = todo.pop()
        near = alike(words[rows], words[i])
        if near.any():
            hit, rows = rows[near], rows[~near]
            todo += hit.tolist()
            yield np.full(len(hit), i), hit


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what edges `a, b` connect, fewer than there are nodes."""
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    tree = np.arange(len(nodes))
    while True:
        x, y = tree[x], tree[y]
        x, y = x[x != y], y[x != y]
        if not len(x):
            break
        np.minimum.at(tree, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := tree[tree], tree):
            tree = up
    other = np.flatnonzero(tree != np.arange(len(tree)))
    return nodes[tree[other]], nodes[other]


def _whole_groups(batches: Iterator[pa.RecordBatch], bits: list[str],
                  rows: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Key, ids and bit words of a sorted stream, in stretches of some `rows` that
    end where a group ends."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        words = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in bits], axis=1)
        held.append((key, batch.column("id").to_numpy(), words))
        size += len(key)
        if size < rows:
            continue
        whole = [np.concatenate(x) for x in zip(*held)]
        last = np.flatnonzero(whole[0][1:] != whole[0][:-1])
        stop = int(last[-1]) + 1 if len(last) else 0
        if stop:
            yield tuple(x[:stop] for x in whole)
        held, size = [tuple(x[stop:] for x in whole)], len(whole[0]) - stop
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


# Components -----------------------------------------------------------------------

def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """`id, comp` for every id of an edge: the least id of its connected
    component. Alternating large and small stars; every round is two
    aggregations by node (minimum, with partial aggregation) joined back to
    the edges, written to the shared folder, until a round changes nothing."""
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
            few(edges.sparkSession))
    seen = _print(e)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        # a round never adds edges beyond twice those it had
        e = cut(small, 1 + seen[0] // EDGES_PER_TASK)
        now = _print(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("comp"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots)


def _print(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


# Blocks ----------------------------------------------------------------------------

def blocks(members: DataFrame, block_rows: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """`id, comp, block, part, parts, *keep` from `id, comp, *keep`: the blocks in which
    every two members of a component meet at least once. A component of up to
    `block_rows` is one block; a larger one is split in parts of half that size
    on average. Two members of one part meet in several blocks; `home` says
    which of these is theirs."""
    # only the large components are joined back, by broadcast while they are few,
    # so that the members of one do not meet in a task before they are dealt out
    large = cut(members.groupBy("comp").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
                .select("comp", F.ceil(F.col("_n") * 2 / block_rows).cast("bigint").alias("_parts")), few(members.sparkSession))
    if large.count() <= LARGE_BROADCAST:
        large = F.broadcast(large)
    part = F.pmod(F.xxhash64("id"), F.col("_parts"))
    return (members.join(large, "comp", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("bigint")))
            .withColumn("part", part)
            .select("id", "comp", F.explode(pairs_of_parts(F.col("part"), F.col("_parts"))).alias("block"),
                    "part", F.col("_parts").alias("parts"), *keep))


def sketch_blocks(members: DataFrame, block_rows: int, same: int) -> DataFrame | None:
    """`id, comp, block` of the members (id, comp, sketch) of components of more than
    `block_rows`: blocks in which every two of a component meet that have `same`
    equal bytes in their sketches. None where there are no such components. A block
    that is too large falls into smaller ones by one byte more that is equal, where
    that makes fewer rows than pairs of parts do, and in pairs of parts at last."""
    spark = members.sparkSession
    size = members.groupBy("comp").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
    rows = cut(members.join(_hinted(cut(size, few(spark))), "comp")
               .select("id", "comp", "sketch", "_n", F.lit(0).cast("bigint").alias("block"), F.lit(0).alias("agreed")), few(spark))
    parts = F.ceil(F.col("_n") * 2 / block_rows).cast("bigint")
    made = []

    def cost(n: str) -> Column:      # rows of the blocks that one of n rows ends in, as pairs of parts
        return F.when(F.col(n) <= block_rows, F.col(n)).otherwise(F.col(n) * (F.ceil(F.col(n) * 2 / block_rows) - 1))

    for _ in range(same):
        if rows.isEmpty():
            break
        finer = (rows.withColumn("_from", F.col("block"))
                 .select("id", "comp", "sketch", "_from", F.col("_n").alias("_of"),
                         F.explode(byte_keys(F.col("sketch"), F.col("agreed"), same, F.col("block"))).alias("_b"))
                 .select("id", "comp", "sketch", "_from", "_of", "_b.block", "_b.agreed"))
        sizes = finer.groupBy("comp", "_from", "block").agg(F.count(F.lit(1)).alias("_n"), F.first("_of").alias("_of"))
        split = cut(sizes.groupBy("comp", "_from").agg((F.sum(cost("_n")) < F.first(cost("_of"))).alias("_split")), few(spark))
        over = cut(sizes.where(F.col("_n") > block_rows).select("comp", "block", "_n"), few(spark))
        whole = split.where("NOT _split").select("comp", F.col("_from").alias("block"))
        made.append(rows.join(_hinted(whole), ["comp", "block"]))
        finer = (finer.join(_hinted(split.where("_split").select("comp", "_from")), ["comp", "_from"])
                 .join(_hinted(over), ["comp", "block"], "left"))
        made.append(finer.where("_n IS NULL"))
        rows = cut(finer.where("_n IS NOT NULL").select("id", "comp", "sketch", "_n", "block", "agreed"), few(spark))
    made.append(rows)
    if len(made) == 1:
        return None
    part = F.pmod(F.xxhash64("id"), parts)
    dealt = [m.select("id", "comp", "block", "_n") for m in made]
    return (functools.reduce(DataFrame.unionByName, dealt)
            .select("id", "comp", F.explode(F.when(F.col("_n").isNull(), F.array("block")).otherwise(F.transform(
                pairs_of_parts(part, parts), lambda b: F.xxhash64("block", b)))).alias("block")))


def _hinted(few_rows: DataFrame) -> DataFrame:
    """A frame of a row for each large block, which are few but for the largest inputs."""
    return F.broadcast(few_rows) if few_rows.count() <= LARGE_BROADCAST else few_rows


def home(part: np.ndarray, parts: int, block: int) -> np.ndarray:
    """For members of a block: whether pairs inside their own part are counted
    here, which is so in exactly one block: the one with the part after."""
    if parts <= 1:
        return np.ones(len(part), dtype=bool)
    low, high = divmod(block, parts)
    other = np.where(part == low, high, low)
    return other == (part + 1) % parts


def compare_blocks(rows: DataFrame, compare: Callable[..., tuple], schema: str, tasks: int | None = None,
                   together: int = 0) -> DataFrame:
    """Runs `compare` on the rows of every (comp, block) and returns what it
    gives: arrays of the columns of `schema`. Blocks cost by their pairs, not by
    their bytes: `tasks` says how many partitions they are dealt to, which
    adaptive execution then leaves alone. With `together`, `compare` gets several
    whole blocks of about so many rows, and where each of them starts."""
    dealt = rows.repartition(*([tasks] if tasks else []), "comp", "block").sortWithinPartitions("comp", "block")
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())      # it gives back what is freed: workers go on to other tasks
        found = sorted_groups(batches, ["comp", "block"])
        for args in gathered(found, together) if together else ((t,) for t in found):
            out = compare(*args)
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in out], names)
        trim()

    return dealt.mapInArrow(run, schema)


def gathered(tables: Iterator[pa.Table], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables put together to some `rows` or BYTES, and where each begins."""
    held: list[pa.Table] = []
    size = n_bytes = 0
    for t in tables:
        held.append(t)
        size += t.num_rows
        n_bytes += t.nbytes
        if size >= rows or n_bytes >= BYTES:
            yield _together(held)
            held, size, n_bytes = [], 0, 0
    if held:
        yield _together(held)


def _together(held: list[pa.Table]) -> tuple[pa.Table, np.ndarray]:
    begin = np.cumsum([0] + [t.num_rows for t in held[:-1]])
    return pa.concat_tables(held).combine_chunks(), begin
