"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a text that has a word gets a good/bad label. Its features are
shares and counts of the line cut into steps, the same of the lines before and
after it, and whether it is the first or last. Scores of the two labels and of
label changes are fitted by gradient steps on the likelihood of a bounded sample
of labelled documents, whose lines all carry the document's label. For a new
document the forward-backward marginals of "good", weighted by line length, are
averaged, and a logistic function fitted on the same sample turns the average
into the score.

Only the text is an input of the score. Fitting is bounded by the sample sizes
below; scoring reads every whole text, one row at a time; memory follows the
longest text.

Defined results: a null text, or one without words, has no lines and gets the
least score that the logistic function gives; repeated rows are scored alike; a
null doc_id counts as held out; an empty table gives an empty result; without
labelled rows the prior 0.5 is the score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import training
from quarry.llm.common import SPACES, cut

MAX_TRAIN = (2500, 4000)      # bad, good
MAX_TRAIN_CHARS = 50_000
THRESHOLD = 0.5
EPOCHS = 150

# Steps of the line features: a line's value falls between two of them.
_STEPS = {
    "words": (2, 5, 10, 20, 50, 100),
    "word_chars": (2, 3, 4, 5, 6, 8, 12),
    "symbols": (0.001, 0.02, 0.05, 0.1, 0.2, 0.4),       # of the characters
    "upper": (0.02, 0.1, 0.3, 0.6),
    "digits": (0.01, 0.05, 0.2),
    "marks": (0.01, 0.03, 0.06, 0.12),                   # ! ? and the like
    "distinct": (0.1, 0.25, 0.4, 0.6, 0.8, 0.95),        # of the words
    "twins": (0.02, 0.1, 0.3, 0.6),                      # words equal to the word before
    "seen": (0.5,),                                      # the line was there before
}
_SYMBOLS = "#*$%&|<>{}[]\\^~_=+@/"
_MARKS = "!?;:"
# ASCII characters only: no byte of another UTF-8 character equals one of these
_DELETE = {n: c.encode() for n, c in (("symbols", _SYMBOLS), ("marks", _MARKS), ("digits", "0123456789"))}

_OFFSETS: dict[str, int] = {}
_n = 0
for _name, _s in _STEPS.items():
    _OFFSETS[_name] = _n
    _n += len(_s) + 1
ONE = _n                         # features of one line, without its neighbours
WIDTH = 3 * ONE + 2              # own, previous, next; first, last


def lines_of(text: str | None) -> list[str]:
    return [x for x in (text or "").split("\n") if x.strip(SPACES)]


def line_values(lines: list[str]) -> np.ndarray:
    """One row of numbers per line, in the order of _STEPS."""
    out = np.empty((len(lines), len(_STEPS)))
    before: set[str] = set()
    for k, line in enumerate(lines):
        ws = line.split()
        n, chars = max(1, len(ws)), max(1, len(line))
        raw = line.encode("utf-8", "surrogatepass")
        symbols, digits, marks = (len(raw) - len(raw.translate(None, _DELETE[c])) for c in ("symbols", "digits", "marks"))
        solid = sum(map(len, ws))
        lower = line.lower()
        upper = sum(map(str.isupper, line)) if lower != line else 0
        out[k] = (len(ws), solid / n, symbols / chars, upper / max(1, solid), digits / chars, marks / chars,
                  len(set(ws)) / n,
                  sum(map(str.__eq__, ws[1:], ws)) / n, float(line in before))
        before.add(line)
    return out


def active(values: np.ndarray) -> np.ndarray:
    """Numbers of the active features per line: own, previous and next line's,
    first and last. Absent neighbours point at one extra, unused feature."""
    n = len(values)
    own = np.empty((n, len(_STEPS)), dtype=np.int64)
    for c, (name, steps) in enumerate(_STEPS.items()):
        own[:, c] = _OFFSETS[name] + np.searchsorted(np.array(steps), values[:, c], side="right")
    none = np.full((1, own.shape[1]), WIDTH, dtype=np.int64)
    prev = np.vstack((none, own[:-1] + ONE))
    nxt = np.vstack((own[1:] + 2 * ONE, none))
    ends = np.full((n, 2), WIDTH, dtype=np.int64)
    ends[0, 0], ends[-1, 1] = 3 * ONE, 3 * ONE + 1
    return np.hstack((own, prev, nxt, ends))


@dataclass
class Crf:
    """weight of each feature for "good" over "bad" (the last one is 0), and
    scores of going from label to label (bad 0, good 1)."""
    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def marginals(self, act: np.ndarray) -> np.ndarray:
        """P(good) of every line of one document."""
        p, _, _ = chain(self.weights[act].sum(axis=1)[None, :], np.array([len(act)]), self.moves)
        return p[0]

    def weighted(self, act: np.ndarray, size: np.ndarray) -> float:
        """Length-weighted mean of the marginals of one document's lines."""
        return float(np.average(self.marginals(act), weights=size))

    def average(self, text: str | None) -> float | None:
        lines = lines_of(text)
        if not lines:
            return None
        return self.weighted(active(line_values(lines)), np.array([len(x) for x in lines]))

    def score(self, text: str | None) -> float:
        a = self.average(text)
        return float(training.sigmoid(np.array(self.slope * logit(0.0 if a is None else a) + self.offset)))


def logit(p: float | np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p) - np.log1p(-p)


def chain(unary: np.ndarray, length: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over a batch of chains padded to one width: P(good)
    per place, expected number of every move, log of the normaliser."""
    n, width = unary.shape
    fwd = np.zeros((n, width, 2))
    fwd[:, 0, 1] = unary[:, 0]
    for t in range(1, width):
        step = fwd[:, t - 1, :, None] + moves
        fwd[:, t] = np.logaddexp(step[:, 0], step[:, 1])
        fwd[:, t, 1] += unary[:, t]
    end = fwd[np.arange(n), length - 1]
    z = np.logaddexp(end[:, 0], end[:, 1])
    bwd = np.zeros((n, width, 2))
    counts = np.zeros((2, 2))
    for t in range(width - 2, -1, -1):
        ahead = bwd[:, t + 1].copy()
        ahead[:, 1] += unary[:, t + 1]
        step = moves + ahead[:, None, :]
        inside = (t + 1 < length)[:, None]
        bwd[:, t] = np.where(inside, np.logaddexp(step[:, :, 0], step[:, :, 1]), 0.0)
        pair = np.exp(fwd[:, t, :, None] + step - z[:, None, None])
        counts += (pair * inside[:, :, None]).sum(axis=0)
    post = np.exp(fwd + bwd - z[:, None, None])
    return post[:, :, 1] * (np.arange(width) < length[:, None]), counts, z


def fit_crf(acts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, ridge: float = 1e-4) -> Crf:
    """Likelihood gradient with per-weight step sizes (Adam) over all sample
    documents; both classes weigh the same. Chains are batched by length."""
    crf = Crf(np.zeros(WIDTH + 1), np.zeros((2, 2)))
    if not len(acts) or len(set(labels.tolist())) < 2:
        return crf
    share = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    order = np.argsort([len(a) for a in acts], kind="stable")
    batches = []
    for some in np.array_split(order, max(1, len(order) // 200)):
        length = np.array([len(acts[i]) for i in some])
        act = np.full((len(some), length.max(), acts[0].shape[1]), WIDTH, dtype=np.int64)
        for r, i in enumerate(some):
            act[r, :length[r]] = acts[i]
        batches.append((act, length, labels[some], share[some]))
    total = sum(len(a) for a in acts)
    m = np.zeros(WIDTH + 5)
    v = np.zeros(WIDTH + 5)
    for epoch in range(1, epochs + 1):
        grad = np.zeros(WIDTH + 5)
        for act, length, y, w in batches:
            unary = crf.weights[act].sum(axis=2)
            good, _, _ = chain(unary, length, crf.moves)
            inside = np.arange(act.shape[1]) < length[:, None]
            diff = (y[:, None] - good) * inside * w[:, None]
            grad[:WIDTH + 1] += np.bincount(act.reshape(-1), np.repeat(diff.reshape(-1), act.shape[2]), WIDTH + 1)
            for label in (0, 1):      # all lines of a document carry its label
                own = y == label
                if own.any():
                    _, expected, _ = chain(unary[own], length[own], crf.moves)
                    seen = np.zeros((2, 2))
                    seen[label, label] = (length[own] - 1).sum()
                    grad[WIDTH + 1:] += ((seen - expected) * w[own][0]).reshape(-1)
        grad = grad / total
        grad[WIDTH] = 0.0
        grad[:WIDTH] -= ridge * crf.weights[:WIDTH]
        grad[WIDTH + 1:] -= 10 * ridge * crf.moves.reshape(-1)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        step = 0.05 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
        crf.weights[:WIDTH] += step[:WIDTH]
        crf.moves += step[WIDTH + 1:].reshape(2, 2)
    return crf


def fit(docs: DataFrame, labels: DataFrame) -> Crf:
    """Line features of the sample are made by Spark tasks; the fit sees at
    most 1.25 x MAX_TRAIN documents of small numbers."""
    sample = cut(training.training_texts(docs, labels, "quality", MAX_TRAIN, MAX_TRAIN_CHARS), training.TASKS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lines_of(t) for t in batch.column("_text").to_pylist()]
            acts = [active(line_values(x)).astype(np.int16).tobytes() if x else b"" for x in found]
            sizes = [np.array([len(line) for line in x], dtype=np.int32).tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("_label"), pa.array(acts, pa.binary()),
                                              pa.array(sizes, pa.binary())], ["_label", "act", "sizes"])

    rows = sample.select("_text", "_label").mapInArrow(measure, "_label int, act binary, sizes binary").orderBy(
        "act", "sizes", "_label").collect()
    rows = [r for r in rows if r["act"]]
    per = 3 * len(_STEPS) + 2
    acts = [np.frombuffer(r["act"], dtype=np.int16).reshape(-1, per).astype(np.int64) for r in rows]
    y = np.array([r["_label"] for r in rows], dtype=np.int64)
    crf = fit_crf(acts, y)
    if len(acts) and len(set(y.tolist())) == 2:
        x = np.array([logit(crf.weighted(a, np.frombuffer(r["sizes"], dtype=np.int32))) for a, r in zip(acts, rows)])
        w = training.logistic(x[:, None], y, ridge=0.1)
        crf.slope, crf.offset = float(w[0]), float(w[1])
    return crf


def score(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)    # some hundred weights

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([model.score(t) for t in batch.column("text").to_pylist()], pa.float64())],
                ["doc_id", "score"])

    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return base.mapInArrow(work, "doc_id bigint, score double").select(
        "doc_id", training.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
