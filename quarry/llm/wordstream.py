"""Words of many texts as one byte stream.

Every word of a text is followed by one space; white space beyond that is gone.
With `ends`, every text is closed by a line feed, which no word holds, so a
stream of texts can be taken apart again without any other mark. All of it is
numpy over the bytes of an Arrow column: no Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quarry.llm.bytescan import Words, _SPACE

SPACE, END = 0x20, 0x0A
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Stream:
    """`bytes`: the stream; `offsets`: where every token starts (one more entry
    at the end); `first`: the first token of every text (one more at the end).
    Tokens are the words, each with its space, and with `ends` the line feed.
    With `pad`, every text is preceded by a token of so many line feeds."""

    def __init__(self, data: np.ndarray, text_offsets: np.ndarray, *, lower: bool = False,
                 ends: bool = False, pad: int = 0):
        w = Words(data, text_offsets)
        sizes = w.ends - w.starts + 1
        first = w.first
        texts = len(first) - 1
        word = np.ones(len(sizes), dtype=bool)
        if ends or pad:
            at, size = [], []
            if pad:
                at.append(first[:-1])
                size.append(np.full(texts, pad))
            if ends:
                at.append(first[1:])
                size.append(np.ones(texts, dtype=np.int64))
            # in the order of the texts: the pad of one before its end
            at, size = np.stack(at, axis=1).ravel(), np.stack(size, axis=1).ravel()
            sizes = np.insert(sizes, at, size)
            word = np.insert(word, at, False)
            first = first + np.arange(texts + 1) * ((pad > 0) + ends)
        self.first = first
        self.word = word
        self.offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
        out = np.full(self.offsets[-1], SPACE, dtype=np.uint8)
        solid = np.repeat(word, sizes)
        solid[self.offsets[1:] - 1] = False
        marks = ~np.repeat(word, sizes)
        out[marks] = END
        body = data[~_SPACE[data]]
        out[solid] = _LOWER[body] if lower else body
        self.bytes = out

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def tokens(self) -> pa.Array:
        """The tokens as an Arrow column, over the stream's own bytes."""
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(self.offsets), pa.py_buffer(self.bytes)])

    def ids(self) -> np.ndarray:
        """A number for every token; equal tokens have equal numbers."""
        return self.tokens().dictionary_encode().indices.to_numpy(zero_copy_only=False)
