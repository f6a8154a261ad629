"""Toxicity: a learnt lexicon, Levenshtein automata against its trie, and
context windows that tell quotation from abuse.

Lexicon. From a bounded sample of labelled documents (held-out ones are never
read for it), words and word beginnings that stand almost only in toxic texts,
in so many different contexts that chance does not explain it (a copied
sentence is one context). Beginnings stand for words with any ending.

Matching. The trie of the lexicon is intersected with the Levenshtein automaton
of every entry: a state is a set of (trie node, edits so far), a character
leads to the next set, and sets are numbered as they are met, so that a word
costs one table look-up per character. Entries of five to seven letters may be
misspelled by one edit, longer ones by two, if hardly any other text has them;
beginnings and the rest not at all. Misspelled forms seen in non-toxic
sample texts are no misspellings.

Context. A hit counts less when the words around it quote or report: quotation
marks on both sides within the window, or a reporting word before it. Address
to a person in the window takes that back. The document score is a logistic
function of what its hits add up to, fitted on the sample.

Only the text is an input of the score. Fitting is bounded by the sample sizes
below; scoring reads every whole text, one row at a time.

Defined results: a null or empty text has no hits and gets the score of such
texts; repeated rows are scored alike; a null doc_id counts as held out; an
empty table gives an empty result; without labelled rows every score is that
of a text without hits; other columns are not read by `query` and are carried
along by `stage`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import training
from quarry.llm.common import cut

MAX_TRAIN = (9000, 4500)       # not toxic, toxic
MAX_TRAIN_CHARS = 200_000
MAX_ENTRIES = 500
LEAST_LETTERS = 4
CHANCE = 0.01                  # expected number of entries by chance
SHARE = 0.75                   # of an entry's contexts that are toxic, at least
SURE = 0.98                    # the same, for entries that may be misspelled
THRESHOLD = 0.7
WINDOW = 8                     # words on either side
STATES = 60_000                # of the automaton, and words, kept at once

WORD = re.compile(r"[^\W\d_]+")
SPARK_WORD = r"\p{L}+"

# Fixed word lists of the context window (parameters of the operator).
REPORTING = frozenset("said says say wrote writes called calls word words term terms quote quoted quotes "
                      "insult insults slur slurs phrase using used sagte schrieb wort zitat mot terme "
                      "cite dit palabra dijo cita".split())
ADDRESS = frozenset("you your you're youre u ur du dich dein ihr tu te toi ton vous tú te eres usted".split())
QUOTES = frozenset("\"'“”‘’«»„‹›")


def allowed_edits(entry: str) -> int:
    """None for beginnings (they are short, and any ending may follow) and for
    words marked =, which stand in other texts now and then."""
    return 0 if len(entry) < 5 or entry[-1] in "*=" else 1 if len(entry) < 8 else 2


# Automaton -------------------------------------------------------------------------

class Matcher:
    """Lexicon entries (a trailing * means any ending, a trailing = no
    misspelling) as one automaton over characters. `match` gives the fewest edits and the entry, or None."""

    def __init__(self, entries: Iterable[str], benign: Iterable[str] = ()):
        self.entries = sorted(set(entries))
        self.benign = frozenset(benign)
        self._build()

    def __getstate__(self) -> dict:
        return {"entries": self.entries, "benign": self.benign}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._build()

    def _build(self) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]        # entries that end at the node
        self.room: list[int] = [0]               # most edits of any entry below
        for e, entry in enumerate(self.entries):
            word = entry.rstrip("*=")
            node = 0
            path = [0]
            for c in word:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.ends.append([])
                    self.room.append(0)
                node = self.child[node][c]
                path.append(node)
            self.ends[node].append(e)
            for n in path:
                self.room[n] = max(self.room[n], allowed_edits(entry))
        self.letters = frozenset(c for d in self.child for c in d)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[tuple, int] = {}
        self.sets: list[frozenset] = []
        self.open: list[tuple[int, int] | None] = []     # (edits, entry) that any ending keeps
        self.found: list[tuple[int, int] | None] = []    # (edits, entry) if the word ends here
        self.next: dict[tuple[int, str], int] = {}
        self.dead = self._number({}, None)
        items: dict[int, int] = {}
        self._add(items, 0, 0)
        self.start = self._number(items, None)

    def _add(self, items: dict[int, int], node: int, edits: int) -> None:
        """An item, and those reached by leaving out characters of the entry."""
        if edits > self.room[node] or items.get(node, edits + 1) <= edits:
            return
        items[node] = edits
        for n in self.child[node].values():
            self._add(items, n, edits + 1)

    def _number(self, items: dict[int, int], kept: tuple[int, int] | None) -> int:
        whole = kept
        for node, edits in items.items():
            for e in self.ends[node]:
                if edits <= allowed_edits(self.entries[e]):
                    whole = min(whole or (edits, e), (edits, e))
                    if self.entries[e].endswith("*"):
                        kept = min(kept or (edits, e), (edits, e))
        key = (frozenset(items.items()), kept)
        n = self.known.get(key)
        if n is None:
            n = self.known[key] = len(self.sets)
            self.sets.append(key[0])
            self.open.append(kept)
            self.found.append(whole)
        return n

    def _step(self, state: int, c: str) -> int:
        items: dict[int, int] = {}
        for node, edits in self.sets[state]:
            for k, n in self.child[node].items():
                self._add(items, n, edits if k == c else edits + 1)
            self._add(items, node, edits + 1)        # a character too many
        return self._number(items, self.open[state])

    def match(self, word: str) -> tuple[int, str] | None:
        if len(self.sets) > STATES:
            self._reset()
        state, step = self.start, self.next
        for c in word:
            key = (state, c if c in self.letters else "")
            n = step.get(key)
            if n is None:
                n = step[key] = self._step(state, key[1])
            state = n
            if state == self.dead:
                return None
        hit = self.found[state]
        if hit is None or (hit[0] and word in self.benign):
            return None
        return hit[0], self.entries[hit[1]]


# Documents --------------------------------------------------------------------------

def quoted_weight(text: str, begin: int, end: int) -> float:
    """1.0 for plain use of a word, less where its surroundings quote it."""
    before, after = text[max(0, begin - 60):begin], text[end:end + 60]
    near_before, near_after = WORD.findall(before)[-WINDOW:], WORD.findall(after)[:WINDOW]
    marks = any(c in QUOTES for c in before) and any(c in QUOTES for c in after)
    close = before[-1:] in QUOTES and bool(before) and after[:1] in QUOTES and bool(after)
    reported = any(w.lower() in REPORTING for w in near_before)
    addressed = any(w.lower() in ADDRESS for w in near_before[-3:] + near_after[:3])
    if addressed or not (marks or close or reported):
        return 1.0
    return 0.2 if (close or (marks and reported)) else 0.5


FEATURES = ["any_exact", "log_exact", "any_misspelled", "log_misspelled"]


def features(matcher: Matcher, strength: dict[str, float], text: str | None,
             memo: dict[str, tuple[int, str] | None]) -> list[float]:
    """What the hits of a text add up to, each by its entry's strength and
    its surroundings."""
    exact = misspelled = 0.0
    for m in WORD.finditer(text or ""):
        raw = m.group()
        word = raw if raw in memo else raw.lower()
        if word not in memo:
            if len(memo) >= STATES:
                memo.clear()
            memo[word] = matcher.match(word)
        hit = memo[word]
        if hit:
            weight = quoted_weight(text, m.start(), m.end()) * strength[hit[1]]
            if hit[0]:
                misspelled += weight / (1 + hit[0])
            else:
                exact += weight
    return [min(1.0, exact), math.log1p(exact), min(1.0, misspelled), math.log1p(misspelled)]


@dataclass
class Model:
    matcher: Matcher
    strength: dict[str, float]     # of the entries
    weights: list[float]
    memo: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def score(self, text: str | None) -> float:
        x = features(self.matcher, self.strength, text, self.memo)
        z = sum(a * b for a, b in zip(x, self.weights)) + self.weights[-1]
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))


def _lexicon(sample: DataFrame) -> dict[str, float]:
    """Entries and their strength (0 to 1), by counting contexts (a word's neighbours) of words and of
    word beginnings in toxic and in other sample texts."""
    ws = F.regexp_extract_all(F.lower("_text"), F.lit(SPARK_WORD), F.lit(0))
    placed = sample.withColumn("_w", ws).select("_label", F.explode(F.expr(
        "transform(_w, (w, i) -> struct(w AS w, xxhash64(_w[greatest(i - 1, 0)], "
        "_w[least(i + 1, size(_w) - 1)]) AS c))")).alias("_p"))
    contexts = (placed.where(F.length("_p.w") >= LEAST_LETTERS)
                .groupBy(F.col("_p.w").alias("w"), F.col("_p.c").alias("c"))
                .agg(F.min("_label").alias("tox")))    # a context of both counts as clean
    words = cut(contexts.groupBy("w").agg(
        F.sum("tox").alias("tox"), F.sum(1 - F.col("tox")).alias("clean")), training.TASKS)
    starts = F.transform(F.sequence(F.lit(LEAST_LETTERS), F.length("w")), lambda n: F.substring("w", F.lit(1), n))
    begins = (words.select("w", "tox", "clean", F.explode(starts).alias("p")).groupBy("p")
              .agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"),
                   F.max(F.struct("tox", "w")).alias("top")))
    total = words.agg(F.sum("tox"), F.sum("clean"), F.count(F.lit(1))).first()
    if not total[0] or not total[1]:
        return {}
    share = total[0] / (total[0] + total[1])
    # so many toxic contexts that fewer than CHANCE of all candidates get there by chance
    least = max(4, math.ceil(math.log(5 * total[2] / CHANCE) / -math.log(share)))
    rows = (begins.where((F.col("tox") >= least) & (F.col("tox") >= SHARE * (F.col("tox") + F.col("clean"))))
            .select("p", "tox", "clean", "top").orderBy(F.col("tox").desc(), "p").limit(MAX_ENTRIES * 20).collect())
    taken = {r["p"]: r for r in rows}
    out: dict[str, tuple[int, float]] = {}
    for p, r in taken.items():
        if len(p) > LEAST_LETTERS and p[:-1] in taken:
            continue                      # a shorter beginning stands for it
        entry = p + "*"
        if r["top"]["tox"] >= 0.9 * r["tox"]:      # one word makes up the beginning
            entry = r["top"]["w"] + ("" if r["tox"] >= SURE * (r["tox"] + r["clean"]) else "=")
        out[entry] = (r["tox"], min(1.0, math.log((r["tox"] + 1) / (r["clean"] + 1)) / math.log(50)))
    first = sorted(out, key=lambda e: (-out[e][0], e))[:MAX_ENTRIES]
    return {e: out[e][1] for e in first}


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = cut(training.training_texts(docs, labels, "toxic", MAX_TRAIN, MAX_TRAIN_CHARS), training.TASKS)
    strength = _lexicon(sample)
    plain = Matcher(strength)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Misspelled forms in texts that are not toxic."""
        for batch in batches:
            forms = {w for t in batch.column("_text").to_pylist() for w in WORD.findall(t.lower())}
            hits = ((w, plain.match(w)) for w in forms)
            yield pa.RecordBatch.from_arrays([pa.array([w for w, h in hits if h and h[0]], pa.string())], ["w"])

    benign = [r["w"] for r in sample.where("_label = 0").select("_text").mapInArrow(seen, "w string")
              .distinct().orderBy("w").limit(200_000).collect()] if strength else []
    matcher = Matcher(strength, benign)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            x = [features(matcher, strength, t, memo) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), *[pa.array([r[k] for r in x], pa.float64()) for k in range(len(FEATURES))]],
                ["_label", *FEATURES])

    # at most 1.25 x MAX_TRAIN rows of a few numbers
    rows = sample.select("_text", "_label").mapInArrow(
        measure, "_label int, " + ", ".join(f"{f} double" for f in FEATURES)).orderBy(*FEATURES, "_label").collect()
    x = np.array([[r[f] for f in FEATURES] for r in rows]).reshape(-1, len(FEATURES))
    y = np.array([r["_label"] for r in rows])
    if not len(y):
        return Model(matcher, strength, [0.0] * len(FEATURES) + [-2.0])
    return Model(matcher, strength, training.logistic(x, y, ridge=0.1).tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # a few hundred entries

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array([m.score(t) for t in part.column("text").to_pylist()], pa.float64())],
                    ["doc_id", "score"])

    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return base.mapInArrow(work, "doc_id bigint, score double").select(
        "doc_id", training.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                stays = [m.score(t) < THRESHOLD for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(stays, pa.bool_()))

    at = docs.columns.index("text")
    return docs.mapInArrow(work, docs.schema)
