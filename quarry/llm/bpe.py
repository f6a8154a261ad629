"""BPE encoding and decoding by a tokenization automaton.

The automaton's arcs are tokens and its language is exactly the token
sequences that byte-pair merging produces. It is compiled from the merges, one
gadget after the other. Before any merge there is one state with an arc for
every base symbol. The gadget of a merge u v -> w takes the state reached by u,
gives u a copy of it without the arc v (u v must not stand any more), and adds
an arc w wherever there was an arc u; w leads where v led. The state reached
therefore depends on the last token only. The copies are kept as what they
are: a state is the state it was copied from at a certain merge, less the arcs
removed since; so the automaton has one state per token and the construction
is linear in the merges. `arc` answers whether a state has an arc, and keeps
the answers as the transition table.

Every string has exactly one path. Encoding a pre-split word reads its
characters once through the trie of the arcs' labels and finds the state after
every prefix: the one arc that ends there and stands after the state where it
begins. Decoding emits the labels of the arcs.

The tokenizer file also names the rest: NFC, lower case, the split pattern,
bytes written as printable characters, and the end-of-word mark on a word's
last symbol. Special tokens in a text are cut out first. Nothing is truncated
or padded.

The compiled automaton is broadcast (its size is that of the vocabulary, not
of the data). Words repeat, so each Python worker keeps the encodings of the
chunks between spaces met last, at most twice CACHE, and as many of words.

Defined results: a null text is the empty text, which has no tokens; rows are
encoded one by one, repeated rows alike; a null doc_id is kept; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 200_000
STEP = 4                # characters from one kept prefix of words to the next
LONGEST = 16            # characters of a kept prefix
PREFIXES = 100_000      # kept at once
ARCS = 600_000        # answers of the transition table kept at once
_BASE = -1              # "merge number" of base symbols


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, else the next unused one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(shown))
    return [out[b] for b in range(256)]


class Automaton:
    """Compiled merges: one state per token, the one reached by it."""

    def __init__(self, base: list[str], merges: list[tuple[str, str]]):
        self.tokens = list(dict.fromkeys(base))
        self.number = {t: i for i, t in enumerate(self.tokens)}
        n = len(self.tokens)
        self.born = [_BASE] * n          # the merge that made the token
        self.head = [-1] * n             # u of the merge: where arcs were added
        self.tail = [-1] * n             # v of the merge: whose state was copied
        self.cut: dict[tuple[int, int], int] = {}   # (u, v) -> the merge that removed arc v after u
        self._table: dict[int, bool] = {}     # by x << 20 | t
        for i, (u, v) in enumerate(merges):
            self._gadget(i, u, v)

    def _gadget(self, i: int, u: str, v: str) -> None:
        a, b, w = self.number.get(u), self.number.get(v), u + v
        if a is None or b is None or w in self.number or not self._has(a, b, i):
            return              # the pair never stands: there is nothing to merge
        self.cut[a, b] = i
        self.number[w] = len(self.tokens)
        self.tokens.append(w)
        self.born.append(i)
        self.head.append(a)
        self.tail.append(b)

    def arc(self, x: int, t: int) -> bool:
        """Whether the state reached by token x has an arc t."""
        key = x << 20 | t
        found = self._table.get(key)
        if found is None:
            if len(self._table) >= ARCS:
                self._table.clear()
            found = self._table[key] = self._has(x, t, len(self.born) + len(self.cut))
        return found

    def _has(self, x: int, t: int, before: int) -> bool:
        """The same, as of the merges numbered below `before`."""
        while True:
            if self.cut.get((x, t), before) < before:
                return False
            if self.born[x] > self.born[t]:      # x's state is a copy of its tail's
                before = min(before, self.born[x])
                x = self.tail[x]
            elif self.born[t] > self.born[x] or self.born[t] != _BASE:   # t was added where its head was
                before = min(before, self.born[t] + 1)
                t = self.head[t]
            else:
                return True

    def trie(self, end: str) -> dict:
        """Arc labels by their characters, with the links of string matching. A
        node holds its children by character; under 1 the arcs without the mark
        `end` whose labels are suffixes of what was read to get there, as (token,
        length), longest first; under 2 those with it; under 0 the node of the
        longest proper suffix that is in the trie (None for the root). The root
        holds what `path` keeps under 3."""
        root: dict = {0: None, 1: (), 2: (), 3: {}}
        for t, label in enumerate(self.tokens):
            marked = bool(end) and label.endswith(end)
            text = label[:-len(end)] if marked else label
            node = root
            for c in text:
                child = node.get(c)
                if child is None:
                    child = node[c] = {0: root, 1: (), 2: ()}
                node = child
            node[2 if marked else 1] = ((t, len(text)),)
        level = [n for c, n in root.items() if isinstance(c, str)]
        while level:
            below = []
            for node in level:
                for c, child in node.items():
                    if isinstance(c, str):
                        child[0] = step(node[0], c) or root
                        child[1] += child[0][1]
                        child[2] += child[0][2]
                        below.append(child)
            level = below
        return root

    def path(self, word: str, trie: dict, mark: int = 2) -> list[int]:
        """The tokens of a word whose last symbol carries the mark (entry 2 of
        the trie's nodes; entry 1 for no mark): the only path from the start that
        spells the word. Every prefix has one path, too, and the state after it
        is its last token. So the prefixes' states are found one after the other:
        of the arcs that end where the prefix ends, only one leaves the state
        reached where it begins. Then the path is read from the end. Words begin
        alike: the states of prefixes met are kept, by STEP characters."""
        known, slow = self._table.get, self.arc
        prefixes = trie[3]
        n = len(word)
        end = min((n - 1) // STEP * STEP, LONGEST)
        begun = None
        while end > 0:
            begun = prefixes.get(word[:end])
            if begun is not None:
                break
            end -= STEP
        kept = end
        if begun is None:
            end, node, states, lengths = 0, trie, [-1], [0]
        else:
            node, states, lengths = begun[0], begun[1].copy(), begun[2].copy()
        for c in word[end:] if end else word:
            if kept < end <= LONGEST and end % STEP == 0:
                if len(prefixes) >= PREFIXES:
                    prefixes.clear()
                prefixes[word[:end]] = node, states.copy(), lengths.copy()
            end += 1
            node = node.get(c) or step(node[0], c) or trie
            for t, length in node[1] if end < n else node[mark]:
                # a symbol alone comes last: where no longer arc stands, it does
                if length == 1 or length == end:
                    break
                x = states[end - length]
                key = x << 20 | t
                stands = known(key)
                if stands or stands is None and slow(x, t):
                    break
            else:
                raise ValueError(f"no path for {word!r}")
            states.append(t)
            lengths.append(length)
        out: list[int] = []
        while n:
            out.append(states[n])
            n -= lengths[n]
        out.reverse()
        return out


def step(node: dict | None, c: str) -> dict | None:
    """The child by c of the first node from `node` along the suffix links that
    has one."""
    while node is not None:
        child = node.get(c)
        if child is not None:
            return child
        node = node[0]
    return None


class Recent(dict):
    """Up to `size` entries in use, and as many held from before: when it is
    full the held ones go and the present ones are held, so entries asked for
    again stay. `recall` finds a held entry."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size
        self.held: dict = {}

    def recall(self, key):
        found = self.held.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.held = dict(self)
            self.clear()
        self[key] = value


class Tokenizer:
    """A word-level BPE tokenizer file of the `tokenizers` library, run by the
    automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        base = [s + e for e in ("", self.end) for s in self.symbols]
        self.automaton = Automaton(base, [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                                          for m in model["merges"]])
        vocab = model["vocab"]
        self.ids = [vocab.get(t, -1) for t in self.automaton.tokens]
        self.labels = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels |= {i: t for t, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self._prepare()

    def _prepare(self) -> None:
        self._split = regex.compile(self.pattern)
        # the longest special token first, where several begin at one place
        names = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._trie = self.automaton.trie(self.end)
        # an arc without an id fails where it is met
        self._raws = [struct.pack("<I", i) if i >= 0 else None for i in self.ids]
        self._shown = [self.labels.get(i) for i in self.ids]
        self._chunks = Recent(CACHE)
        self._words = Recent(CACHE)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_split", "_special", "_trie", "_raws", "_shown", "_chunks", "_words")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def _normal(self, text: str) -> str:
        # character by character: a capital sigma does not depend on its place
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _made(self, ids: list[int]) -> tuple[bytes, str, int]:
        return struct.pack(f"<{len(ids)}I", *ids), " ".join([self.labels[i] for i in ids]), len(ids)

    def _spelled(self, path: list[int]) -> tuple[bytes, str, int]:
        """The same of arcs."""
        raws, shown = self._raws, self._shown
        return b"".join([raws[t] for t in path]), " ".join([shown[t] for t in path]), len(path)

    def _word(self, piece: str) -> tuple[bytes, str, int]:
        """Encoded ids, labels and number of tokens of one piece of the split pattern."""
        found = self._words.get(piece) or self._words.recall(piece)
        if found is None:
            # printable ASCII characters stand for themselves
            plain = piece.isascii() and piece.isprintable()
            word = piece if plain else "".join([self.symbols[b] for b in piece.encode("utf-8")])
            found = self._spelled(self.automaton.path(word, self._trie))
            self._words.keep(piece, found)
        return found

    def _chunk_pieces(self, chunk: str) -> list[tuple[bytes, str, int]]:
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():      # a word and its mark: two pieces
            text = self._normal(chunk[:-1])
            if text.isalpha():
                return [self._word(text), self._word(chunk[-1])]
        parts = self._special.split(chunk) if self._special and "<" in chunk else [chunk]
        out: list[tuple[bytes, str, int]] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self._made([self.special[part]]))
                continue
            text = self._normal(part)
            out += [self._word(piece) for piece in ([text] if text.isalpha() else self._split.findall(text))]
        return out

    def _chunk(self, chunk: str) -> tuple[bytes, str, int]:
        """The same of what stands between spaces."""
        found = self._chunks.recall(chunk)
        if found is not None:
            return found
        if chunk.isalpha() and (text := self._normal(chunk)).isalpha():
            found = self._word(text)
            self._chunks.keep(chunk, found)
            return found
        made = self._chunk_pieces(chunk)
        if len(made) == 1:
            found = made[0]
        else:
            found = (b"".join([m[0] for m in made]), " ".join([m[1] for m in made]), sum([m[2] for m in made]))
        self._chunks.keep(chunk, found)
        return found

    def pieces(self, text: str | None) -> list[tuple[bytes, str, int]]:
        # no token spans a space or newline, so chunks between them stand alone
        held, make = self._chunks, self._chunk
        chunks = (text or "").replace("\n", " ").split(" ")
        return [held.get(c) or make(c) for c in chunks if c]

    def encode(self, text: str | None) -> list[int]:
        raw = b"".join([p[0] for p in self.pieces(text)])
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))

    def decode(self, ids: list[int]) -> str:
        """Arc labels, one after the other; the file names no decoder, so a
        space stands between them."""
        return " ".join([self.labels[i] for i in ids])


_DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str, carry: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and n_tokens of every document, and the
    bigint column `carry` where one is named."""
    return _run(docs, path, True, carry)


def _run(docs: DataFrame, path: str, with_ids: bool, carry: str | None = None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Tokenizer(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared.value
        gc.freeze()     # the automaton lives as long as the worker: no collection walks it
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                count, raws, digest, back = [], [], [], []
                for text in part.column("text").to_pylist():
                    pieces = tokenizer.pieces(text)
                    raw = b"".join([p[0] for p in pieces])
                    count.append(len(raw) // 4)
                    raws.append(raw)
                    digest.append(hashlib.sha256(raw).hexdigest())
                    back.append(hashlib.sha256(" ".join([p[1] for p in pieces if p[2]]).encode("utf-8")).hexdigest())
                columns = [part.column("doc_id"), pa.array(count, pa.int64()), pa.array(digest, pa.string()),
                           pa.array(back, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    flat = pa.Array.from_buffers(pa.int32(), sum(count), [None, pa.py_buffer(b"".join(raws))])
                    offsets = pa.array([0, *_running(count)], pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, flat))
                    names.append("ids")
                if carry:
                    columns.append(part.column(carry))
                    names.append(carry)
                yield pa.RecordBatch.from_arrays(columns, names)

    more = [carry] if carry else []
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *more)
    return base.mapInArrow(work, ", ".join([_DIGEST, *["ids array<int>"] * with_ids, *[f"{c} bigint" for c in more]]))


def _running(counts: list[int]) -> Iterator[int]:
    total = 0
    for c in counts:
        total += c
        yield total


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(docs: DataFrame, path: str | None = None) -> DataFrame:
    return _run(docs, path or word_tokenizer_path(), False)


def stage(docs: DataFrame, path: str | None = None, carry: str | None = None) -> DataFrame:
    return encode(docs, path or word_tokenizer_path(), carry)
