"""Periodic runs of words, by Baier grouping.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends; runs of at least `MIN_WORDS` words and two periods
are reported.

Method. A run of period q holds, under the order of words or under its reverse,
a Lyndon root of q words: one of its words-long conjugates that is the longest
Lyndon word starting where it starts. So all runs come from the two Lyndon
arrays. `lyndon` computes one by the first phase of Baier's suffix sorter:
positions are grouped by the prefix known so far (at first one word), the
groups are handled from the highest to the lowest, and every position of a group
lengthens the prefix of the nearest position to its left that has not been
handled yet; those that were lengthened by the same count leave their group for
a higher one. The prefix a position has when its group is handled is its longest
Lyndon word. Each of the two roots of a position is then extended to both sides
by longest common extensions; it is a run when the two extensions together are
at least a period long. Extensions are exact, by names of equal stretches of
1, 2, 4, ... words.

Before that, words that cannot be in any run are cut out: a run has every word
of its own at least twice, so a word that occurs once in its stretch is in none
and ends every stretch beside it. This is repeated on what is left, and
stretches of under `MIN_WORDS` words go. It changes no result, and leaves
little of ordinary prose.

One pass over the documents, in Arrow batches, without a shuffle. Memory per
task: a slice of texts (`bytescan.SLICE_BYTES`, one text at least) and names
of four bytes for every word of its repetitive stretches, one set for each
doubling of the longest.

Defined results: null and empty texts have no words and no run; words of
a document with a null id are never rewritten; repeated rows have equal results;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bytescan import slices
from quarry.llm.wordstream import Stream

MIN_WORDS = 12


def lyndon(symbols: list[int], kinds: int) -> list[int]:
    """Lengths of the longest Lyndon word starting at every position of a
    sequence of numbers 0 to kinds - 1: the grouping phase of Baier's sorter."""
    n = len(symbols)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    group = list(symbols)
    known = [1] * kinds                        # length of a group's prefix
    below = list(range(-1, kinds - 1))
    above = list(range(1, kinds + 1))
    above[-1] = -1
    # left[i + 1]: itself while i is not handled; otherwise something to its left
    left = list(range(n + 1))
    out = [0] * n
    top = kinds - 1
    while top >= 0:
        here = [i for i in members[top] if group[i] == top]
        length = known[top]
        for i in here:
            left[i + 1] = i
        grown: dict[int, int] = {}
        for i in here:
            out[i] = length
            x = i
            while left[x] != x:
                left[x] = left[left[x]]
                x = left[x]
            if x:
                grown[x - 1] = grown.get(x - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, count in grown.items():
            moved.setdefault((group[j], count), []).append(j)
        last: dict[int, int] = {}              # the group put in last after one
        for old, count in sorted(moved):
            new = len(known)
            after = last.get(old, old)
            last[old] = new
            members.append(moved[old, count])
            known.append(known[old] + count * length)
            below.append(after)
            above.append(above[after])
            if above[after] >= 0:
                below[above[after]] = new
            above[after] = new
            for j in moved[old, count]:
                group[j] = new
        top = below[top]
    return out


class Names:
    """Names of all stretches of 2**k symbols of a sequence: equal stretches
    have equal names, different ones different names."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.levels = [np.unique(symbols, return_inverse=True)[1].astype(np.int32)]
        size = 1
        while 2 * size <= longest and 2 * size <= len(symbols):
            last = self.levels[-1].astype(np.int64)
            pairs = last[:-size] * (int(last.max()) + 1) + last[size:]
            self.levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
            size *= 2

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch from x and from y on (x < y)."""
        x, y = x.copy(), y.copy()
        start = x.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            # a longest stretch may hold the greatest size several times
            while True:
                fits = np.flatnonzero(y < len(names))
                fits = fits[names[x[fits]] == names[y[fits]]]
                x[fits] += 1 << k
                y[fits] += 1 << k
                if k < len(self.levels) - 1 or not len(fits):
                    break
        return x - start

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that ends before x and y (x < y)."""
        x, y = x.copy(), y.copy()
        start = x.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[k], 1 << k
            while True:
                fits = np.flatnonzero(x >= size)
                fits = fits[names[x[fits] - size] == names[y[fits] - size]]
                x[fits] -= size
                y[fits] -= size
                if k < len(self.levels) - 1 or not len(fits):
                    break
        return start - x


def repetitive(ids: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that may hold a run: `begin, end` word numbers. Words that
    occur once in their stretch are cut out until none is left."""
    at = np.arange(len(ids))
    part = np.repeat(np.arange(len(first) - 1), np.diff(first))
    kinds = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        key = part * kinds + ids[at]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        turn = np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))
        alone = np.zeros(len(at), dtype=bool)
        alone[order] = turn[1:] & turn[:-1]
        # stretches of what is left, the short ones without
        stays = at[~alone]
        cut = np.ones(len(stays) + 1, dtype=bool)
        if len(stays):
            cut[1:-1] = (np.diff(stays) > 1) | (np.diff(part[~alone]) > 0)
        edges = np.flatnonzero(cut)
        size = np.diff(edges)
        keep = size >= least
        stays = stays[np.repeat(keep, size)]
        if len(stays) == len(at):
            break
        at = stays
        part = np.repeat(np.arange(np.count_nonzero(keep)), size[keep])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(np.concatenate(([True], np.diff(part) > 0, [True])))
    return at[edges[:-1]], at[edges[1:] - 1] + 1


def find_runs(ids: np.ndarray, first: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """Rows `start, length, period` of all runs, ordered by start and period.
    `ids`: words as numbers; `first`: the first word of every text and one past
    the last; starts count through all texts."""
    begin, end = repetitive(ids, first, least)
    if not len(begin):
        return np.zeros((0, 3), np.int64)
    sizes = end - begin
    # all stretches one after the other, each followed by a symbol of its own
    place = np.concatenate(([0], np.cumsum(sizes + 1)))
    symbols = np.empty(place[-1], dtype=np.int64)
    starts, lengths = [], []
    for k, (b, e) in enumerate(zip(begin.tolist(), end.tolist())):
        words, ranks = np.unique(ids[b:e], return_inverse=True)
        symbols[place[k]:place[k + 1] - 1] = ids[b:e]
        symbols[place[k + 1] - 1] = -1 - k
        for order in (ranks, len(words) - 1 - ranks):
            starts.append(np.arange(place[k], place[k + 1] - 1))
            lengths.append(np.array(lyndon(order.tolist(), len(words)), dtype=np.int64))
    x, q = np.concatenate(starts), np.concatenate(lengths)
    names = Names(symbols, int(sizes.max()))
    behind, ahead = names.backward(x, x + q), names.forward(x, x + q)
    whole = behind + ahead + q
    run = (whole >= 2 * q) & (whole >= least)
    shift = np.repeat(begin - place[:-1], sizes * 2)       # two orders for every word
    found = np.stack([(x - behind + shift)[run], whole[run], q[run]], axis=1)
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where a document's words are made periodic, and the period; None where
    they stay as they are."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


RESULT = ("doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, "
          "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")


class _Texts:
    """A slice of texts: words as numbers, runs, and which words are dropped."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, doc_ids: list, rewrite: bool, least: int):
        self.stream = Stream(data, offsets)
        self.first = self.stream.first
        self.source = np.arange(len(self.stream))     # the word that stands at every place
        self.changed = [False] * len(doc_ids)
        if rewrite:
            for k, doc_id in enumerate(doc_ids):
                b, e = int(self.first[k]), int(self.first[k + 1])
                found = planted(doc_id, e - b)
                if found:
                    a, p = found
                    self.source[b + a:e] = b + a + np.arange(e - b - a) % p
                    self.changed[k] = True
        self.runs = find_runs(self.stream.ids()[self.source], self.first, least)
        # of every text, its runs
        self.run_first = np.searchsorted(self.runs[:, 0], self.first)
        turn = np.zeros(len(self.stream) + 1, dtype=np.int64)
        np.add.at(turn, self.runs[:, 0] + self.runs[:, 2], 1)
        np.add.at(turn, self.runs[:, 0] + self.runs[:, 1], -1)
        self.dropped = np.cumsum(turn[:-1]) > 0

    def of(self, k: int) -> np.ndarray:
        out = self.runs[self.run_first[k]:self.run_first[k + 1]].copy()
        out[:, 0] -= self.first[k]
        return out

    def collapsed(self, k: int) -> bytes:
        """The kept words of text k, joined by one space."""
        b, e = int(self.first[k]), int(self.first[k + 1])
        at = self.stream.offsets
        if not self.changed[k] and self.run_first[k] == self.run_first[k + 1]:
            return self.stream.bytes[at[b]:max(at[b], at[e] - 1)].tobytes()
        words = self.source[b:e][~self.dropped[b:e]]
        raw = self.stream.bytes
        return b" ".join([raw[x:y - 1].tobytes() for x, y in zip(at[words].tolist(), at[words + 1].tolist())])


def _scan(batches: Iterator[pa.RecordBatch], rewrite: bool, least: int) -> Iterator[tuple[list, _Texts]]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for i, j, data, offsets in slices(batch.column("text")):
            yield ids[i:j], _Texts(data, offsets, ids[i:j], rewrite, least)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))


def runs(docs: DataFrame, *, rewrite: bool = False, least: int = MIN_WORDS) -> DataFrame:
    """`doc_id, start, length, period`: one row for every run of every text.
    With `rewrite`, words are made periodic first, as `planted` says."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, t in _scan(batches, rewrite, least):
            count = np.diff(t.run_first)
            owner = [d for d, n in zip(ids, count.tolist()) for _ in range(n)]
            start = t.runs[:, 0] - np.repeat(t.first[:-1], count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner, pa.int64()), *(pa.array(v) for v in (start, t.runs[:, 1], t.runs[:, 2]))],
                ["doc_id", "start", "length", "period"])

    return _input(docs).mapInArrow(each, "doc_id bigint, start bigint, length bigint, period bigint")


def collapse(docs: DataFrame, *, least: int = MIN_WORDS) -> DataFrame:
    """`doc_id, text`: the words of every text, those of a run after its first
    period left out, joined by one space."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, t in _scan(batches, False, least):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([t.collapsed(k) for k in range(len(ids))], pa.binary()).cast(pa.string())],
                ["doc_id", "text"])

    return _input(docs).mapInArrow(each, "doc_id bigint, text string")


def query(docs: DataFrame) -> DataFrame:
    """One row per document: see `RESULT`."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in RESULT.split(", ")]
        for ids, t in _scan(batches, True, MIN_WORDS):
            rows = []
            for k, doc_id in enumerate(ids):
                found = t.of(k)
                best: tuple = (None,) * 4
                if len(found):
                    start, length, period = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
                    best = (start, length, period, 1000 * length // period)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in found.tolist())
                rows.append((doc_id, int(t.first[k + 1] - t.first[k]), len(found), *best,
                             hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(t.collapsed(k)).hexdigest()))
            types = [pa.int64()] * 7 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return _input(docs).mapInArrow(each, RESULT)
