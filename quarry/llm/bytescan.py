"""Words, lines and their hashes straight from the bytes of Arrow text columns.

All functions work on whole numpy arrays: no Python object per word. A word is
a longest run of bytes outside white space (0x20, 0x09-0x0D), which in UTF-8
is the same as for code points. Hashes are polynomials modulo 2**64, taken as
differences of one running sum and mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Fixed odd multipliers: bytes in a word, words in a sequence, two of each.
_BYTE_MUL = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD_MUL = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
SLICE_BYTES = 1 << 18
MIXED = 1 << 15


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * SLICE_BYTES)
            self.up, self.down = (np.concatenate((
                np.ones(1, dtype=U64), np.multiply.accumulate(np.full(size - 1, b, dtype=U64))))
                for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_BYTE_POWERS = tuple(_Powers(b) for b in _BYTE_MUL)
_WORD_POWERS = tuple(_Powers(b) for b in _WORD_MUL)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over all 64."""
    flat = x.reshape(-1)
    out, high = np.empty(len(flat), dtype=U64), np.empty(min(len(flat), MIXED), dtype=U64)
    for at in range(0, len(flat), MIXED):      # so many at once as stay in a processor's cache
        y = out[at:at + MIXED]
        h = high[:len(y)]
        np.right_shift(flat[at:at + MIXED], U64(32), out=y)
        y ^= flat[at:at + MIXED]
        y *= U64(0xD6E8FEB86659FD93)
        np.right_shift(y, U64(32), out=h)
        y ^= h
        y *= U64(0xD6E8FEB86659FD93)
        np.right_shift(y, U64(32), out=h)
        y ^= h
    return out.reshape(x.shape)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """A hash of every run values[start:end] of non-zero 64-bit values."""
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of a text column of about `limit` bytes (one row at
    least): first row, end row, their bytes, offsets from 0. Null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, len(column))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


class Words:
    """The words of consecutive texts: byte spans, and which text each is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = np.zeros(len(data) + 2, dtype=bool)
        solid[1:-1] = ~_SPACE[data]
        turn = solid[1:] != solid[:-1]
        inner = offsets[1:-1]
        # a text's end cuts a word in two, where both sides are solid
        cut = inner[(inner > 0) & (inner < len(data))]
        cut = np.unique(cut[solid[cut] & solid[cut + 1]])
        self.solid = solid[1:-1]      # the bytes of words
        edges = np.flatnonzero(turn)
        self.starts = np.sort(np.concatenate((edges[::2], cut)))
        self.ends = np.sort(np.concatenate((edges[1::2], cut)))
        self.data = data
        # first word of every text, and one past the last
        self.first = np.searchsorted(self.starts, offsets).astype(np.int64)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        values = self.data.astype(U64) + U64(1)
        return run_hashes(values, self.starts, self.ends, _BYTE_POWERS[which])


def sequence_hashes(word_hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of every run of words."""
    return run_hashes(word_hashes | U64(1), starts, ends, _WORD_POWERS[which])


def shingles(word_hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `size` words of every text, in order, and the
    index of every text's first window (one more entry at the end). A text of
    fewer words, but one at least, is one window."""
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.concatenate((np.zeros(1, np.int64), np.cumsum(count)))
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], count)
    end = np.minimum(at + size, np.repeat(first[1:], count))
    return sequence_hashes(word_hashes, at, end), begin


def reduce_runs(op: np.ufunc, values: np.ndarray, begin: np.ndarray, empty, dtype=None) -> np.ndarray:
    """op over every run values[begin[i]:begin[i + 1]]; `empty` for empty runs."""
    out = np.full((len(begin) - 1, *values.shape[1:]), empty, dtype=dtype or values.dtype)
    full = begin[1:] > begin[:-1]
    if full.any():
        out[full] = op.reduceat(values, begin[:-1][full], axis=0, dtype=dtype)
    return out
