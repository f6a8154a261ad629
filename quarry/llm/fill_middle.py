"""Fill-in-the-middle texts, put together by a secondary sort.

A text is cut into units (runs of letters A-Z and a-z, and every other code
point alone), and at two of them into prefix, middle and suffix. The output is
the text itself (`plain`), or the three parts behind sentinels with the middle
last (`psm`: prefix first, `spm`: suffix first).

Method: the DataFrame form of repartitionAndSortWithinPartitions. Every text is
emitted as pieces of at most `CHUNK` units, keyed by the document and by their
position in the output; the sentinels are pieces of their own. Pieces are
shuffled by document and sorted by (document, position) within partitions, and
stream in that order into one incremental digest, so an output is never held
whole. For the restoration the stream of output pieces alone is read, with its
form: a sentinel says which part begins, which gives every piece behind it its
place in the text. The pieces are sorted again by that place, in the partition
they are in, and stream into the second digest.

Key. Two 64-bit hashes of the input partition, the id and the text. Equal rows of
one partition share a key; their equal pieces come side by side and are counted,
so each gets its row in the result. The key depends on which rows are in a
partition and not on their order, so a recomputed task emits the same ones.

Plan: one shuffle with the texts once, two sorts in partitions. Memory per task:
one batch of pieces. `outputs` and `restored` give whole texts, one at a time.

Defined results: a null text counts as empty; empty texts, texts that contain
a sentinel, and all texts of a null id stay plain; repeated rows have equal
results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bytescan import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
CHUNK = 4096                # units of a piece
PLAIN_OF_100, SPM_OF_100 = 10, 20
PART = 40                   # bits of a piece's number in its part
_PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_LAST = 3 << PART           # sorts behind all pieces

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True

PIECES = ("k1 bigint, k2 bigint, pos bigint, piece binary, doc_id bigint, n bigint, form string, "
          "prefix_chars bigint, middle_chars bigint")
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_NAMES = [c.split(" ")[0] for c in PIECES.split(", ")]


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where the units of consecutive texts start, and the
    first unit of every text (one more entry at the end)."""
    letter = _LETTER[data]
    inside = np.zeros(len(data), dtype=bool)
    inside[1:] = letter[1:] & letter[:-1]
    inside[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(~inside & ((data & 0xC0) != 0x80))
    return starts, np.searchsorted(starts, offsets)


def _draws(doc_id: int) -> tuple[int, int, int, int]:
    h = hashlib.sha256(b"1:%d" % doc_id).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def plan(doc_id: int | None, n: int, text: bytes) -> tuple[str, int, int]:
    """Form, and the units after which the prefix and the middle end."""
    if doc_id is None or not n or any(s in text for s in SENTINELS):
        return "plain", 0, 0
    h1, h2, h3, h4 = _draws(doc_id)
    if h3 % 100 >= 100 - PLAIN_OF_100:
        return "plain", 0, 0
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < SPM_OF_100 else "psm"), x, y


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of every text. The first one of a text tells id, form and counts."""
    for batch in batches:
        ids, k1, k2 = (batch.column(c).to_pylist() for c in ("doc_id", "k1", "k2"))
        for i, j, data, offsets in slices(batch.column("text")):
            starts, first = unit_starts(data, offsets)
            edges = np.concatenate((starts, [len(data)]))
            rows: list[tuple] = []
            for k in range(j - i):
                lo, hi = int(offsets[k]), int(offsets[k + 1])
                f, n = int(first[k]), int(first[k + 1] - first[k])
                form, x, y = plan(ids[i + k], n, data[lo:hi].tobytes())
                if form == "plain":
                    parts = [(None, 0, n)]
                    counts = (None, None)
                else:
                    p, m, s = (PREFIX, 0, x), (MIDDLE, x, y), (SUFFIX, y, n)
                    parts = [p, s, m] if form == "psm" else [s, p, m]
                    counts = (_chars(data[lo:edges[f + x]]), _chars(data[edges[f + x]:edges[f + y]]))
                pieces: list[bytes] = []
                for mark, a, b in parts:
                    if mark:
                        pieces.append(mark)
                    for c in range(a, b, CHUNK):
                        pieces.append(data[edges[f + c]:edges[f + min(c + CHUNK, b)]].tobytes())
                head = (ids[i + k], n, form, *counts)
                for pos, piece in enumerate(pieces or [b""]):
                    rows.append((k1[i + k], k2[i + k], pos, piece, *(head if pos == 0 else (None,) * 5)))
            yield _batch(rows, _TYPES, _NAMES)


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def pieces(docs: DataFrame) -> DataFrame:
    """The output pieces of every text, shuffled by document and sorted by
    output position within partitions."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    key = lambda seed: F.xxhash64(F.lit(seed), F.spark_partition_id(), "doc_id", "text")
    return (source.select("doc_id", "text", key(1).alias("k1"), key(2).alias("k2"))
            .mapInArrow(_cut, PIECES)
            .repartition("k1", "k2").sortWithinPartitions("k1", "k2", "pos"))


def _documents(batches: Iterator[pa.RecordBatch], columns: list[str], order: str) -> Iterator[tuple]:
    """Rows of a sorted stream, without the repetitions that equal documents
    make: (new document?, copies so far at this position, row)."""
    key = place = None
    copies = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            at = columns.index(order)
            if row[:2] != key:
                key, place, copies = row[:2], row[at], 1
                yield True, 1, row
            elif row[at] == place:
                copies += 1
                yield False, copies, row
            else:
                place, copies = row[at], 1
                yield False, 1, row


class _Assembly:
    """Takes the pieces of one output in order; says where each belongs."""

    def __init__(self, head: tuple):
        self.head, self.copies, self.sha = head, 1, hashlib.sha256()
        self.part, self.count = 0, 0

    def place(self, piece: bytes) -> int | None:
        """The place of an output piece in the text; None for a sentinel."""
        self.sha.update(piece)
        if self.head[2] != "plain" and piece in _PLACE:
            self.part, self.count = _PLACE[piece], 0
            return None
        self.count += 1
        return (self.part << PART) + self.count


_TRAILED = PIECES.replace("pos bigint", "place bigint") + ", copies bigint, output_sha256 string"


def _digest_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order in, pieces with their place in the text out. One
    more row behind each document's pieces holds its head and output digest."""
    names = [c.split(" ")[0] for c in _TRAILED.split(", ")]
    types = [*_TYPES, pa.int64(), pa.string()]
    none = (None,) * 7
    rows: list[tuple] = []
    held = 0
    doc: _Assembly | None = None
    key: tuple = ()

    def trailer() -> tuple:
        return (*key, _LAST, None, *doc.head, doc.copies, doc.sha.hexdigest())

    for new, copies, row in _documents(batches, _NAMES, "pos"):
        if new:
            if doc:
                rows.append(trailer())
            key, doc = row[:2], _Assembly(row[4:])
        if copies > 1:
            doc.copies = max(doc.copies, copies)
            continue
        place = doc.place(row[3])
        if place is not None:
            rows.append((*key, place, row[3], *none))
            held += len(row[3])
        if held > 1 << 20 or len(rows) > 4096:
            yield _batch(rows, types, names)
            rows, held = [], 0
    if doc:
        rows.append(trailer())
    if rows:
        yield _batch(rows, types, names)


RESULT = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
          "output_sha256 string, restored_sha256 string")


def _digest_restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in RESULT.split(", ")]
    types = [*_TYPES[4:], pa.string(), pa.string()]
    columns = [c.split(" ")[0] for c in _TRAILED.split(", ")]
    for batch in _restored_rows(batches, columns):
        yield _batch(batch, types, names)


def _restored_rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    rows: list[tuple] = []
    sha = hashlib.sha256()
    for new, _, row in _documents(batches, columns, "place"):
        if new:
            sha = hashlib.sha256()
        if row[2] != _LAST:
            sha.update(row[3])
            continue
        rows += [(*row[4:9], row[10], sha.hexdigest())] * row[9]
        if len(rows) > 4096:
            yield rows
            rows = []
    if rows:
        yield rows


def query(docs: DataFrame) -> DataFrame:
    """One row per document: see `RESULT`."""
    placed = pieces(docs).mapInArrow(_digest_outputs, _TRAILED)
    # every document's pieces are in one partition already: no second shuffle
    return placed.sortWithinPartitions("k1", "k2", "place").mapInArrow(_digest_restored, RESULT)


# Whole texts ------------------------------------------------------------------------

def _joined(columns: list[str], order: str, end: Callable[[list[bytes], tuple], tuple], schema: str,
            types: list) -> Callable:
    """Joins the pieces of every document in the order they come in."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        head: tuple = ()
        most = 0
        for new, copies, row in _documents(batches, columns, order):
            if new:
                if most:
                    yield _batch([end(held, head)] * most, types, names)
                held, head, most = [], row, 1
            if copies > 1:
                most = max(most, copies)
            else:
                held.append(row[3])
        if most:
            yield _batch([end(held, head)] * most, types, names)

    return run


OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def outputs(docs: DataFrame) -> DataFrame:
    """The whole output texts: `OUTPUT`."""
    join = _joined(_NAMES, "pos", lambda held, row: (*row[4:9], b"".join(held).decode()), OUTPUT,
                   [*_TYPES[4:], pa.string()])
    return pieces(docs).mapInArrow(join, OUTPUT)


def _split_output(text: bytes, form: str) -> list[tuple[int, bytes]]:
    """The parts of an output, each with its place in the text."""
    if form == "plain":
        return [(0, text)]
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    found, at = [], len(order[0])
    for mark, after in zip(order, (*order[1:], None)):
        stop = len(text) if after is None else text.index(after, at)
        found.append((_PLACE[mark], text[at:stop]))
        at = stop + (len(after) if after else 0)
    return found


def restored(outs: DataFrame) -> DataFrame:
    """`doc_id, text` from `doc_id, form, output`: the texts before the
    transformation, by the same sort of pieces."""
    schema = "k1 bigint, k2 bigint, place bigint, piece binary, doc_id bigint"
    names = [c.split(" ")[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, form, text, a, b in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "form", "output", "k1", "k2"))):
                yield _batch([(a, b, place, part, doc_id) for place, part in
                              _split_output((text or "").encode(), form or "plain")], types, names)

    key = lambda seed: F.xxhash64(F.lit(seed), F.spark_partition_id(), "doc_id", "form", "output")
    parts = (outs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "form", "output",
                         key(1).alias("k1"), key(2).alias("k2"))
             .mapInArrow(cut, schema).repartition("k1", "k2").sortWithinPartitions("k1", "k2", "place"))
    join = _joined(names, "place", lambda held, row: (row[4], b"".join(held).decode()), "doc_id bigint, text string",
                   [pa.int64(), pa.string()])
    return parts.mapInArrow(join, "doc_id bigint, text string")
