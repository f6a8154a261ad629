"""Scores of texts by context-tree weighting over bytes.

Model. A text is its lower-cased words, each followed by a space, and one line
feed: so many bytes stand for its tokens and nothing else. Every byte is eight
binary decisions, from the high bit down; the decisions taken so far name one of
255 nodes. Every node has a context tree of its own: the `DEPTH` bytes before, the
nearest first (line feeds before the first byte). A tree node that saw a zeros
and b ones gives the Krichevsky-Trofimov estimate (x + 1/2) / (a + b + 1); its
weighted probability is half that of its own estimates over all it saw, and half
the product of its children's weighted ones. So a decision's probability is a
mixture over all depths, whose weights follow from the counts. Where a context
was never seen, the next shorter one decides alone; every factor remains a
probability, so those of all texts add up to one. `bits_per_byte` is the code
length.

Only the runs of DEPTH + 1 bytes and their counts are needed: all nodes' counts
are sums over them, and a byte's probability depends on its run alone.

Plan. Documents are dealt into blocks of about `BLOCK_BYTES` of text by a hash.
1. Every block is reduced to its distinct byte runs and words, with their counts
   in the texts that are learnt from; that table is written once.
2. Runs are added up over all blocks and dealt by their last two context bytes.
   A task goes through its runs in order, in stretches of whole three-byte contexts
   (256**3 runs at most), takes the deeper levels' nodes there, and emits what
   the second level needs. Levels one and none, up to 65,280 nodes whatever the
   corpus, are combined on the driver. A second pass over the same runs
   has every weight and emits each run's log probability.
3. Runs and words of the blocks are joined with probabilities and counts, which
   go to the block that asked. A task there holds the distinct runs and words of
   its block, and streams the block's texts against them.
Nothing that grows with the corpus is broadcast or held by the driver, and all
counts cover all documents. A run or word found everywhere has one row per block.

Defined results: null texts are empty, which is one token, the end; a null id is
held out, so not learnt from; repeated rows are learnt from as often as they
occur and have equal results; with nothing to learn from every bit is one half and
the base score 0 for each token; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.bytescan import _BYTE_POWERS, run_hashes, slices
from quarry.llm.common import store
from quarry.llm.wordstream import Stream

DEPTH = 5                        # bytes of context
BLOCK_BYTES = 32 << 20
SLICE = 1 << 19                  # bytes of text handled at a time
STRETCH = 200_000                # runs handled at a time, whole three-byte contexts
FOLDS = 10
LOG_HALF = math.log(0.5)


def held_out(doc_id: Column) -> Column:
    """Texts that are not learnt from: crc32 of the id as text is a multiple of ten."""
    crc = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    return F.coalesce(F.pmod(crc, F.lit(FOLDS)) == 0, F.lit(True))


# Byte runs and words of a block -----------------------------------------------------

def byte_runs(s: Stream) -> np.ndarray:
    """For every byte of a padded stream: the bytes before it, the nearest in the
    highest place, then the byte itself. Pads give runs too, which mean nothing."""
    b = s.bytes.astype(np.int64)
    out = b.copy()
    for k in range(1, DEPTH + 1):
        out[k:] |= b[:-k] << (8 * (DEPTH + 1 - k))
    return out


def _streams(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, int, Stream]]:
    for i, j, data, offsets in slices(batch.column("text"), limit):
        yield i, j, Stream(data, offsets, lower=True, ends=True, pad=DEPTH)


class _Counts:
    """Distinct keys of up to 48 bits and their counts, added up in parts. What came
    since the last merge is held as one number a key, the count in the low 16 bits,
    and is no more than what is merged already: a merge holds little besides both."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys, counts = keys.view(np.uint64) << np.uint64(16), counts.view(np.uint64)
        while len(keys):
            self.new.append(keys | np.minimum(counts, np.uint64(0xFFFF)))
            self.held += len(keys)
            more = counts > np.uint64(0xFFFF)
            keys, counts = keys[more], counts[more] - np.uint64(0xFFFF)
        if self.held > max(len(self.keys), 200_000):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.held:
            new = np.concatenate(self.new)
            self.new, self.held = [], 0
            new.sort()
            keys = (new >> np.uint64(16)).view(np.int64)
            begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            counts = np.add.reduceat((new & np.uint64(0xFFFF)).view(np.int64), begin)
            keys = keys[begin]
            del new, begin
            at = np.searchsorted(self.keys, keys)
            known = np.zeros(len(keys), dtype=bool)
            inside = at < len(self.keys)
            known[inside] = self.keys[at[inside]] == keys[inside]
            self.counts[at[known]] += counts[known]
            self.keys, self.counts = (np.insert(x, at[~known], y[~known])
                                      for x, y in ((self.keys, keys), (self.counts, counts)))
        return self.keys, self.counts


class _Words:
    """Distinct words and their counts, added up in parts."""

    def __init__(self):
        self.parts: list[tuple[pa.Array, np.ndarray]] = []
        self.held = 0

    def add(self, words: pa.Array, counts: np.ndarray) -> None:
        self.parts.append((words, counts))
        self.held += len(words)
        if self.held > 4 * max(len(self.parts[0][0]), 100_000):
            self.merge()

    def merge(self) -> tuple[pa.Array, np.ndarray]:
        if not self.parts:
            return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
        coded = pa.concat_arrays([w for w, _ in self.parts]).dictionary_encode()
        counts = np.bincount(coded.indices.to_numpy(zero_copy_only=False),
                             np.concatenate([c for _, c in self.parts]), len(coded.dictionary)).astype(np.int64)
        self.parts, self.held = [(coded.dictionary, counts)], len(counts)
        return self.parts[0]


def _add(s: Stream, learn: np.ndarray, runs: _Counts, words: _Words) -> None:
    sizes = np.diff(s.offsets)
    weight = np.repeat(learn, np.diff(s.first)).astype(np.int64)      # of every token
    pad = np.zeros(len(s), dtype=bool)
    pad[s.first[:-1]] = True
    real = ~np.repeat(pad, sizes)
    marked = np.sort((byte_runs(s)[real] << 1) | np.repeat(weight, sizes)[real])
    begin = np.flatnonzero(np.concatenate(([True], marked[1:] != marked[:-1]))) if len(marked) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(marked)))
    marked = marked[begin]
    runs.add(marked >> 1, np.where(marked & 1, count, 0))
    coded = s.tokens().filter(pa.array(~pad)).dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False)
    words.add(coded.dictionary, np.bincount(at, weight[~pad], len(coded.dictionary)).astype(np.int64))


ASKED = "block int, run bigint, word binary, n bigint"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct byte runs and words of the blocks in a task."""
    pa.set_memory_pool(pa.system_memory_pool())      # it gives back what is freed: workers go on to other tasks
    found: dict[int, tuple[_Counts, _Words]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        learn = batch.column("learn").to_numpy(zero_copy_only=False)
        for b in np.unique(block).tolist():
            rows = np.flatnonzero(block == b)
            runs, words = found.setdefault(b, (_Counts(), _Words()))
            part = batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))
            for i, j, s in _streams(part, SLICE):
                _add(s, learn[rows[i:j]], runs, words)
    for b in list(found):
        runs, words = found.pop(b)
        keys, counts = runs.merge()
        for k in range(0, len(keys), 50_000):
            n = len(keys[k:k + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, b, np.int32)), pa.array(keys[k:k + n]), pa.nulls(n, pa.binary()),
                 pa.array(counts[k:k + n])], ["block", "run", "word", "n"])
        texts, counts = words.merge()
        for k in range(0, len(texts), 50_000):
            part = texts.slice(k, 50_000).cast(pa.binary())
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, b, np.int32)), pa.nulls(n, pa.int64()), part, pa.array(counts[k:k + n])],
                ["block", "run", "word", "n"])


# The tree ------------------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0: Stirling's series, at x + 8."""
    shifted = np.ones_like(x)
    for k in range(8):
        shifted = shifted * (x + k)
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7) + 1 / (1188 * z ** 9)
    with np.errstate(over="ignore"):
        whole = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    # the product overflows only where its logarithm can be taken term by term
    big = x > 1e30
    return np.where(big, whole, whole - np.log(np.where(big, 1.0, shifted)))


def log_estimate(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a node's own sequence, by Krichevsky-Trofimov."""
    total, ones = total.astype(np.float64), ones.astype(np.float64)
    return log_gamma(total - ones + 0.5) + log_gamma(ones + 0.5) - log_gamma(total + 1) - math.log(math.pi)


def weigh(total: np.ndarray, ones: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes, and the weight of their own estimate."""
    own = log_estimate(total, ones)
    weighted = LOG_HALF + np.logaddexp(own, children)
    return weighted, np.exp(LOG_HALF + own - weighted)


class _Level:
    """Contexts of one depth: its (context, byte) pairs in order, their counts,
    and the pair that every pair of the next deeper level belongs to."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, below: np.ndarray | None):
        self.pairs, self.counts, self.below = pairs, counts, below

    def shorter(self) -> _Level:
        pairs, place = np.unique(((self.pairs >> 16) << 8) | (self.pairs & 255), return_inverse=True)
        return _Level(pairs, np.bincount(place, self.counts, len(pairs)), place)

    def nodes(self, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of the j-th decision: first pair, node of every pair, seen, ones."""
        key = self.pairs >> (8 - j)
        turn = np.concatenate(([True], key[1:] != key[:-1]))
        begin = np.flatnonzero(turn)
        bit = (self.pairs >> (7 - j)) & 1
        return (begin, np.cumsum(turn) - 1, np.add.reduceat(self.counts, begin),
                np.add.reduceat(self.counts * bit, begin))


def _levels(runs: np.ndarray, counts: np.ndarray, least: int) -> list[_Level]:
    """From DEPTH bytes of context down to `least`."""
    out = [_Level(runs, counts.astype(np.float64), None)]
    for _ in range(DEPTH - least):
        out.append(out[-1].shorter())
    return out


def _inner(levels: list[_Level], j: int) -> tuple[list[tuple], np.ndarray, np.ndarray, tuple]:
    """Weights of all levels but the last, from the deepest up; for the last one
    the sum of its children's log weighted probabilities, per node."""
    seen = []
    children: np.ndarray | None = None
    weighted = np.zeros(0)
    nodes: tuple = ()
    for d, level in enumerate(levels):
        begin, node, total, ones = nodes_of = level.nodes(j)
        if d:
            parent = node[level.below[nodes[0]]]
            children = np.bincount(parent, weighted, len(begin))
        nodes = nodes_of
        if d == len(levels) - 1:
            break
        if d:
            weighted, own = weigh(total, ones, children)
        else:
            weighted, own = log_estimate(total, ones), np.ones(len(begin))
        seen.append((node, total, ones, own))
    return seen, children, nodes[0], nodes


SECOND = "ctx int, node int, total double, ones double, children double"


def second_level(runs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """What a stretch of runs adds to the nodes of two-byte contexts."""
    levels = _levels(runs, counts, 2)
    out = []
    for j in range(8):
        _, children, begin, (_, _, total, ones) = _inner(levels, j)
        pair = levels[-1].pairs[begin]
        out.append((pair >> 8, (1 << j) | ((pair & 255) >> (8 - j)), total, ones, children))
    return tuple(np.concatenate(x) for x in zip(*out))


class Top:
    """Levels none and one: of every node what was seen and its weight; the
    one-byte contexts as a table of 256 by 256."""

    def __init__(self, byte: np.ndarray, node: np.ndarray, total: np.ndarray, ones: np.ndarray, children: np.ndarray):
        self.total1, self.ones1, below = (np.zeros((256, 256)) for _ in range(3))
        for table, values in ((self.total1, total), (self.ones1, ones), (below, children)):
            np.add.at(table, (byte, node), values)
        weighted, self.own1 = weigh(self.total1, self.ones1, below)
        self.total0, self.ones0 = self.total1.sum(axis=0), self.ones1.sum(axis=0)
        _, self.own0 = weigh(self.total0, self.ones0, np.where(self.total1 > 0, weighted, 0).sum(axis=0))


def _estimate(total, ones, bit):
    return (np.where(bit, ones, total - ones) + 0.5) / (total + 1)


def log_probabilities(runs: np.ndarray, counts: np.ndarray, top: Top, second: tuple[np.ndarray, ...]) -> np.ndarray:
    """log10 of the probability of every run's last byte after its context.
    `second`: keys (context << 8 | node, in order), seen, ones and weights."""
    levels = _levels(runs, counts, 2)
    keys, total2, ones2, own2 = second
    out = np.zeros(len(runs))
    # the pair at every level that a run belongs to
    pair = [np.arange(len(runs))]
    for level in levels[1:]:
        pair.append(level.below[pair[-1]])
    ctx2, byte, ctx1 = runs >> 32, runs & 255, runs >> 40
    for j in range(8):
        bit = (byte >> (7 - j)) & 1 == 1
        seen, _, _, _ = _inner(levels, j)
        p, known = np.full(len(runs), 0.5), np.zeros(len(runs), dtype=bool)

        def mix(p, known, total, ones, own):
            estimate = _estimate(total, ones, bit)
            return np.where(known, own * estimate + (1 - own) * p, estimate), total > 0

        for d, (node, total, ones, own) in enumerate(seen):
            at = node[pair[d]]
            p, known = mix(p, known, total[at], ones[at], own[at])
        n = (1 << j) | (byte >> (8 - j))
        at = np.searchsorted(keys, (ctx2 << 8) | n)
        p, known = mix(p, known, total2[at], ones2[at], own2[at])
        p, known = mix(p, known, top.total1[ctx1, n], top.ones1[ctx1, n], top.own1[ctx1, n])
        p, known = mix(p, known, top.total0[n], top.ones0[n], top.own0[n])
        out += np.log10(p)
    return out


def _stretches(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Sorted rows in stretches that end where a three-byte context ends."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
        size += batch.num_rows
        if size < STRETCH:
            continue
        whole = [np.concatenate(x) for x in zip(*held)]
        ctx = whole[0] >> 24
        stop = int(np.searchsorted(ctx, ctx[-1]))
        if stop:
            yield [x[:stop] for x in whole]
        held, size = [[x[stop:] for x in whole]], len(ctx) - stop
    if size:
        yield [np.concatenate(x) for x in zip(*held)]


def _to_second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for runs, counts in _stretches(batches, ["run", "n"]):
        ctx, node, total, ones, children = second_level(runs, counts)
        yield pa.RecordBatch.from_arrays([pa.array(ctx.astype(np.int32)), pa.array(node.astype(np.int32)),
                                          pa.array(total), pa.array(ones), pa.array(children)],
                                         ["ctx", "node", "total", "ones", "children"])


def _weigh_second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ctx, node, total, ones, children = (c.to_numpy() for c in batch.columns)
        weighted, own = weigh(total, ones, children)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(own), pa.array(np.where(total > 0, weighted, 0))],
                                         ["ctx", "node", "total", "ones", "own", "weighted"])


def model(asked: DataFrame) -> DataFrame:
    """`run, lp`: log10 probability of the last byte of every distinct byte run
    of `block, run, word, n`."""
    runs = store(asked.where(F.col("run").isNotNull()).groupBy("run").agg(F.sum("n").alias("n")))
    ctx = F.shiftright("run", 32)
    dealt = runs.select(ctx.alias("ctx"), "run", "n").repartition("ctx").sortWithinPartitions("run")
    second = store(dealt.mapInArrow(_to_second, SECOND).groupBy("ctx", "node")
                   .agg(F.sum("total").alias("total"), F.sum("ones").alias("ones"), F.sum("children").alias("children"))
                   .mapInArrow(_weigh_second, "ctx int, node int, total double, ones double, own double, weighted double"))
    # up to 256 x 255 rows, whatever the corpus
    first = (second.groupBy(F.shiftright("ctx", 8).alias("byte"), "node")
             .agg(F.sum("total"), F.sum("ones"), F.sum("weighted")).collect())
    columns = list(zip(*first)) if first else [[]] * 5
    top = Top(*(np.array(c, dtype=np.int64) for c in columns[:2]), *(np.array(c, dtype=np.float64) for c in columns[2:]))

    def to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: list[list[np.ndarray]] = []
        known: tuple = ()

        def rest() -> Iterator[pa.RecordBatch]:
            # the nodes of two-byte contexts come before all runs
            for batch in batches:
                nodes = batch.filter(pc.is_null(batch.column("run")))
                if nodes.num_rows:
                    key = (nodes.column("ctx").to_numpy() << 8) | nodes.column("node").to_numpy(zero_copy_only=False).astype(np.int64)
                    tables.append([key, *(nodes.column(c).to_numpy(zero_copy_only=False) for c in ("total", "ones", "own"))])
                yield batch.filter(pc.is_valid(batch.column("run")))

        for runs, counts in _stretches(rest(), ["run", "n"]):
            if not known:
                whole = [np.concatenate(x) for x in zip(*tables)]
                order = np.argsort(whole[0])
                known = tuple(x[order] for x in whole)
            lp = log_probabilities(runs, counts, top, known)
            yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(lp)], ["run", "lp"])

    both = (runs.select(ctx.alias("ctx"), "run", "n", *(F.lit(None).cast(t).alias(c) for c, t in
                                                         (("node", "int"), ("total", "double"), ("ones", "double"), ("own", "double"))))
            .unionByName(second.select(F.col("ctx").cast("bigint").alias("ctx"), F.lit(None).cast("bigint").alias("run"),
                                       F.lit(None).cast("bigint").alias("n"), "node", "total", "ones", "own")))
    return store(both.repartition("ctx").sortWithinPartitions(F.asc_nulls_first("run")).mapInArrow(to_runs, "run bigint, lp double"))


# Scores --------------------------------------------------------------------------------

class _Table:
    """Values by 64-bit key: a slot table, and a search for the keys whose slot
    another one has taken. Only keys of the table may be asked for."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        self.slots = np.zeros(1 << int(64 - self.shift), dtype=np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        if len(wrong):
            at[wrong] = np.searchsorted(self.keys, keys[wrong])
        return self.values[at]


def _hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    values = data.astype(np.uint64) + np.uint64(1)
    return run_hashes(values, offsets[:-1], offsets[1:], _BYTE_POWERS[0]).view(np.int64)


class _WordCounts:
    """Counts of a block's words, by their hashes; by the words themselves in
    the rare block where two words share one."""

    def __init__(self, words: pa.Array, counts: np.ndarray):
        keys = [_hashes(data, offsets) for _, _, data, offsets in slices(words)]
        found = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.table = _Table(found, counts) if len(np.unique(found)) == len(found) else None
        self.words, self.counts = (None, None) if self.table else (words, counts)

    def get(self, s: Stream) -> np.ndarray:
        """Of every token; pads give anything."""
        if self.table:
            keys = _hashes(s.bytes, s.offsets)
            keys[s.first[:-1]] = self.table.keys[0]
            return self.table.get(keys)
        coded = s.tokens().dictionary_encode()
        place = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), 0).to_numpy(zero_copy_only=False)
        return self.counts[place][coded.indices.to_numpy(zero_copy_only=False)]


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, score double, n_bytes bigint"


ROWS = "block int, kind int, number bigint, lp double, text binary"
RUN, WORD, LEARNT, HELD_OUT = range(4)       # kinds of rows


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`ROWS` of blocks, in order of (block, kind): the block's byte runs and their
    probabilities, its words and their counts, its texts and their ids. Numbers are
    copied out of the batches, which are not held."""
    pa.set_memory_pool(pa.system_memory_pool())
    block = None
    found: dict[int, list] = {}
    table: _Table | None = None
    words: _WordCounts | None = None
    names = [c.split(" ")[0] for c in SCORED.split(", ")]
    for batch in batches:
        key = batch.column("block").to_numpy().astype(np.int64) * 4 + batch.column("kind").to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else [0]
        for lo, hi in zip(edges[:-1], edges[1:]):
            part = batch.slice(lo, hi - lo)
            b, kind = divmod(int(key[lo]), 4)
            if b != block:
                block, found, table, words = b, {RUN: [], WORD: []}, None, None
            if kind == RUN:
                found[RUN].append([np.array(part.column(c)) for c in ("number", "lp")])
                continue
            if table is None:
                # the runs are all there: their table before the words come
                table = _Table(*(np.concatenate(x) for x in zip(*found.pop(RUN))))
            if kind == WORD:
                # a slice would hold its whole batch
                found[WORD].append((pa.concat_arrays([part.column("text").cast(pa.large_binary()), pa.array([], pa.large_binary())]),
                                    np.array(part.column("number"))))
                continue
            if words is None:
                texts, counts = zip(*found.pop(WORD))
                words = _WordCounts(pa.concat_arrays(texts), np.concatenate(counts))
                del texts, counts
            for i, j, s in _streams(part, SLICE):
                yield pa.RecordBatch.from_arrays(
                    [part.column("number").slice(i, j - i), pa.array(np.full(j - i, kind == HELD_OUT)),
                     *(pa.array(x) for x in _texts(s, table, words))], names)


def _texts(s: Stream, table: _Table, words: _WordCounts) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, sum of log10(c + 0.1), score and bytes of every text."""
    pad = np.zeros(len(s), dtype=bool)
    pad[s.first[:-1]] = True
    # every text has one token at least, its end; one less token each without the pads
    first = s.first - np.arange(len(s.first))
    c = words.get(s)[~pad]
    tokens = np.diff(first)
    known = np.add.reduceat((c > 0).astype(np.int64), first[:-1])
    logs = np.add.reduceat(np.log10(c + 0.1), first[:-1])
    sizes = np.diff(s.offsets)
    real = ~np.repeat(pad, sizes)
    lp = table.get(byte_runs(s)[real])
    begin = s.offsets[s.first] - DEPTH * np.arange(len(s.first))
    return tokens, known, logs, np.add.reduceat(lp, begin[:-1]), np.diff(begin)


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """`block, doc_id, held_out, text` and the number of blocks: one for
    `block_bytes` of text, and one for each core at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-size // block_bytes), min(docs.sparkSession.sparkContext.defaultParallelism, 1 + size // (1 << 20)))
    doc_id = F.col("doc_id").cast("bigint")
    block = F.pmod(F.xxhash64(doc_id, "text"), F.lit(n)).cast("int")
    return docs.select(block.alias("block"), doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"),
                       F.coalesce("text", F.lit("")).alias("text")), n


def scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: `doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte`."""
    dealt, n = blocks(docs, block_bytes)
    asked = store(dealt.select("block", (~F.col("held_out")).alias("learn"), "text")
                  .repartitionById(n, "block").mapInArrow(_count, ASKED))
    lp = model(asked)
    per_word = Window.partitionBy("word")
    counted = store(asked.where(F.col("word").isNotNull())
                    .select("block", "word", F.sum("n").over(per_word).alias("c"),
                            (F.row_number().over(per_word.orderBy("block")) == 1).alias("one")))
    total = counted.where("one").agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    train, kinds = total[0] or 0, total[1] or 0

    def rows(frame: DataFrame, kind: Column, given: dict[str, str | Column]) -> DataFrame:
        types = {"number": "bigint", "lp": "double", "text": "binary"}
        return frame.select("block", kind.alias("kind"),
                            *((F.col(given[c]) if isinstance(given.get(c), str) else given.get(c, F.lit(None))).cast(t).alias(c)
                              for c, t in types.items()))

    answers = asked.where(F.col("run").isNotNull()).select("block", "run").join(lp, "run")
    every = (rows(answers, F.lit(RUN), {"number": "run", "lp": "lp"})
             .unionByName(rows(counted, F.lit(WORD), {"number": "c", "text": "word"}))
             .unionByName(rows(dealt, F.when(F.col("held_out"), HELD_OUT).otherwise(LEARNT),
                               {"number": "doc_id", "text": F.encode("text", "UTF-8")})))
    scored = every.repartitionById(n, "block").sortWithinPartitions("block", "kind").mapInArrow(_score, SCORED)
    base = F.col("logs") - F.col("n_tokens") * F.lit(math.log10(train + 0.1 * (kinds + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train).cast("bigint").alias("train_tokens"),
                         base.alias("base_score"), "score",
                         (F.col("score") * F.lit(-math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))


def query(docs: DataFrame) -> DataFrame:
    return scores(docs)
