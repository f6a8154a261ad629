"""N-gram Jaccard join with Bayesian candidate pruning.

Two documents are linked when the Jaccard similarity of their sets of five-word
shingles is 0.8 or more. MinHash values are compared a few at a time; with a
uniform prior over the similarity, the posterior probability that it reaches
the threshold follows from the matches so far, and a pair is dropped as soon
as that probability falls below a tolerance. What survives is verified on the
exact shingle sets.

Plan. One pass over the texts gives each document a hash of its words and a
signature of MinHash values. Documents of equal words become one class, by one
aggregation with partial aggregation; only classes go on. Classes that agree in
a band of the signature share a bucket. Inside buckets the first comparison
looks at one bit of every MinHash value (two equal values give equal bits,
others agree half the time) and prunes by the same posterior; a spanning forest
of what is left is emitted. Candidates inside a connected component are then
compared on whole values and on the shingle sets, in blocks of bounded size
(`groups`). Links are counted, not emitted: per document the number of others
it is linked to, and a spanning forest of links, whose components are the
classes of the result.

A pair of similarity 0.8 shares no band with probability (1 - 0.8**4)**24,
about 3 in a million, less above 0.8; the tolerances of the pruning steps are
of that order.

Defined results: a null or empty text has no words; all texts without words
are one class; a text of one to four words is one shingle; rows with equal
doc_id and text count as documents of their own in `n_links` (`stage` keeps
one); a null doc_id orders before all others; an empty table gives an empty
result; `query` reads doc_id and text, `stage` carries all columns along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import bytescan, groups
from quarry.llm.common import few, store

SHINGLE = 5
NUM, DEN = 4, 5          # the threshold 0.8 as a fraction: checked in integers
THRESHOLD = NUM / DEN
ROWS, BANDS = 4, 24
VALUES = ROWS * BANDS
STEP = 16                # MinHash values compared at a time
TOLERANCE = 1e-6         # posterior probability below which a pair is dropped
BLOCK_DOCS = 512

_SCAN = "doc_id bigint, tk bigint, k1 bigint, k2 bigint, sig binary"


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n pairs of 32-bit numbers, the second ones odd, from one seed."""
    x = bytescan.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (x[:n] >> np.uint64(32)).astype(np.uint32), (x[n:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signatures(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MinHash values of runs of shingle hashes: one row of VALUES each."""
    flips, muls = _multipliers(VALUES)
    out = np.full((len(begin) - 1, VALUES), 0xFFFFFFFF, dtype=np.uint32)
    full = begin[1:] > begin[:-1]
    at = begin[:-1][full]
    if len(at):
        h = (hashes >> np.uint64(32)).astype(np.uint32)
        v = np.empty_like(h)
        for k in range(VALUES):
            np.bitwise_xor(h, flips[k], out=v)
            np.multiply(v, muls[k], out=v)
            out[full, k] = np.minimum.reduceat(v, at)
    return out


def least_matches(n: int, share: float, tolerance: float = TOLERANCE) -> int:
    """The fewest matches among n comparisons with which the posterior
    probability that the chance of a match is `share` or more stays at the
    tolerance or above: under a uniform prior it is the probability of at most
    so many successes in n + 1 draws."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * share**m * (1 - share) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in bytescan.slices(batch.column("text")):
            words = bytescan.Words(data, offsets)
            hashes = words.hashes()
            k1, k2 = (bytescan.sequence_hashes(hashes, words.first[:-1], words.first[1:], k).view(np.int64)
                      for k in (0, 1))
            sig = signatures(*bytescan.shingles(hashes, words.first, SHINGLE))
            some = words.first[1:] > words.first[:-1]
            raw = pa.array([r.tobytes() if w else None for r, w in zip(sig, some)], type=pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), batch.column("tk").slice(i, j - i),
                 pa.array(k1), pa.array(k2), raw], ["doc_id", "tk", "k1", "k2", "sig"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, VALUES)


def bit_words(sig: np.ndarray) -> np.ndarray:
    """One well-mixed bit of every value: rows x 64-bit words, zero-padded."""
    bits = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(15)).astype(np.uint8) & 1
    packed = np.packbits(np.pad(bits, ((0, 0), (0, -VALUES % 64))), axis=1)
    return packed.view(np.uint64).reshape(len(sig), -1)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and band: key, id, bits."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            sig = _matrix(part.column("sig"))
            n = len(sig)
            keys = np.zeros((n, BANDS), dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
            for r in range(ROWS):
                keys = bytescan.mix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS].astype(np.uint64))
            bits = bit_words(sig).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)),
                 pa.array(np.repeat(part.column("id").to_numpy(), BANDS)),
                 *[pa.array(np.repeat(bits[:, w], BANDS)) for w in range(bits.shape[1])]],
                ["key", "id", "b0", "b1"])


def _compare(t: pa.Table) -> tuple[list[int], list[int], list[int]]:
    """Of one block: rows (0, a, b), a spanning forest of its links, and rows
    (1, id, number of linked documents) for the links that are counted here."""
    ids, at = np.unique(t.column("id").to_numpy(), return_index=True)   # repeated rows come once
    t = t.take(pa.array(at))
    sig, n_docs = _matrix(t.column("sig")), t.column("n_docs").to_numpy()
    part = t.column("part").to_numpy()
    own = groups.home(part, int(t.column("parts")[0].as_py()), int(t.column("block")[0].as_py()))
    fewest = [least_matches(k + STEP, THRESHOLD) for k in range(0, VALUES, STEP)]
    n = len(ids)
    sets: list[np.ndarray | None] = [None] * n
    texts = t.column("text")

    def of(i: int) -> np.ndarray:
        if sets[i] is None:
            found = [np.zeros(0, np.uint64)]
            for _, _, data, offsets in bytescan.slices(pa.array([texts[i].as_py()], type=pa.string())):
                words = bytescan.Words(data, offsets)
                found.append(bytescan.shingles(words.hashes(), words.first, SHINGLE)[0])
            sets[i] = np.unique(np.concatenate(found))
        return sets[i]

    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kind: list[int] = []
    a: list[int] = []
    b: list[int] = []
    links = np.zeros(n, dtype=np.int64)
    for i in range(n - 1):
        active = np.arange(i + 1, n)
        active = active[(part[active] != part[i]) | own[active]]
        same = np.zeros(len(active), dtype=np.int64)
        for s, least in zip(range(0, VALUES, STEP), fewest):
            same += (sig[active, s:s + STEP] == sig[i, s:s + STEP]).sum(axis=1)
            keep = same >= least
            active, same = active[keep], same[keep]
            if not len(active):
                break
        if not len(active):
            continue
        mine = of(i)
        others = [of(j) for j in active.tolist()]
        flat = np.concatenate(others)
        place = np.searchsorted(mine, flat)
        hit = mine[np.minimum(place, len(mine) - 1)] == flat
        size = np.array([len(o) for o in others])
        begin = np.concatenate(([0], np.cumsum(size)))
        shared = bytescan.reduce_runs(np.add, hit, begin, 0, dtype=np.int64)
        linked = active[DEN * shared >= NUM * (len(mine) + size - shared)]
        links[i] += n_docs[linked].sum()
        links[linked] += n_docs[i]
        for j in linked.tolist():
            p, q = find(i), find(j)
            if p != q:
                root[max(p, q)] = min(p, q)
                kind.append(0)
                a.append(int(ids[i]))
                b.append(int(ids[j]))
    some = np.flatnonzero(links)
    return kind + [1] * len(some), a + ids[some].tolist(), b + links[some].tolist()


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`rows`: one row per document, doc_id, tk (hash of the text), k1, k2 (its
    class of equal words). `found`: one row per class of equal words: k1, k2,
    n_docs, links (documents of other classes linked to it), and `keep`, the
    least (doc_id, tk) of all documents connected with it."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("tk"), "text")
    scanned = store(base.mapInArrow(_scan, _SCAN))
    equal = store(scanned.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "tk")).alias("first"), F.count(F.lit(1)).alias("n_docs"),
        F.first("sig").alias("sig")).withColumn("id", F.monotonically_increasing_id()), few(docs.sparkSession))
    bands = equal.where(F.col("sig").isNotNull()).select("id", "sig").mapInArrow(
        _bands, "key bigint, id bigint, b0 bigint, b1 bigint")
    apart = VALUES - least_matches(VALUES, (1 + THRESHOLD) / 2)
    members = groups.components(groups.bucket_edges(bands, ["b0", "b1"], apart))
    wanted = (groups.blocks(members, BLOCK_DOCS)
              .join(equal.select("id", "n_docs", "sig", "first"), "id")
              .select("id", "comp", "block", "part", "parts", "n_docs", "sig",
                      F.col("first.doc_id").alias("_rd"), F.col("first.tk").alias("_rt")))
    texts = base.join(wanted, base["doc_id"].eqNullSafe(wanted["_rd"]) & (base["tk"] == wanted["_rt"]))
    linked = store(groups.compare_blocks(
        texts.select("id", "comp", "block", "part", "parts", "n_docs", "sig", "text"),
        _compare, "kind bigint, a bigint, b bigint"), few(docs.sparkSession))
    together = groups.components(linked.where("kind = 0").select("a", "b"))
    counted = linked.where("kind = 1").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))
    first = equal.select("id", "first")
    keeper = together.join(first, "id").groupBy("comp").agg(F.min("first").alias("keep"))
    found = (equal.select("id", "k1", "k2", "n_docs", "first")
             .join(together.join(keeper, "comp").select("id", "keep"), "id", "left")
             .join(counted, "id", "left")
             .select("k1", "k2", "n_docs", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"),
                     F.coalesce("keep", "first").alias("keep")))
    return scanned.select("doc_id", "tk", "k1", "k2"), found


def query(docs: DataFrame) -> DataFrame:
    """One row per document: its class (the least doc_id among the documents
    connected with it), how many documents have the same words, and how many
    other documents are linked to it, those with the same words included."""
    rows, found = classes(docs)
    return rows.join(found, ["k1", "k2"]).select(
        "doc_id", F.col("keep.doc_id").alias("class_id"), F.col("n_docs").alias("n_same"),
        (F.col("links") + F.col("n_docs") - 1).alias("n_links"))


def stage(docs: DataFrame) -> DataFrame:
    """The documents with one of every class: the least by (doc_id, hash of
    the text); of rows equal in both, the least by all columns' hash."""
    rows, found = classes(docs)
    keep = found.select("keep.doc_id", "keep.tk").distinct()
    keep = keep.select(F.col("doc_id").alias("_rd"), F.col("tk").alias("_rt"))
    on = lambda f: f["doc_id"].eqNullSafe(keep["_rd"]) & (f["tk"] == keep["_rt"])
    stays = (rows.join(keep, on(rows), "left_semi").groupBy("doc_id", "tk")
             .agg(F.count(F.lit(1)).alias("_rows"))
             .withColumnsRenamed({"doc_id": "_rd", "tk": "_rt"}))
    packed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("tk"))
    kept = packed.join(stays, packed["doc_id"].eqNullSafe(stays["_rd"]) & (packed["tk"] == stays["_rt"]))
    nth = Window.partitionBy("_rd", "_rt").orderBy(F.xxhash64("_row"))
    repeated = (kept.where("_rows > 1").withColumn("_nth", F.row_number().over(nth)).where("_nth = 1")
                .select("_row"))
    out = kept.where("_rows = 1").select("_row").unionByName(repeated)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
