"""Personal data by a semi-Markov conditional random field on top of patterns.

Base spans are the leftmost non-overlapping matches of one pattern per kind
(email, ip, card, phone), with the checks that the patterns cannot express;
they always stay. The model adds spans that the patterns miss: written-out or
spaced addresses, numbers without a plus sign, separated digits.

A semi-Markov model scores whole candidate spans. Around every place that could
belong to personal data the text is cut into atoms (runs of letters or digits,
single other characters, runs of white space); a candidate is up to MAX_ATOMS
atoms that are no white space, and its features look at it as a whole: how many digits, Luhn's check,
dotted quads, address and number shapes, what it touches, which word stands
before it. A dynamic programme over the atoms chooses boundaries and kinds
together; atoms outside entities score 0. An added span never overlaps a base
span.

Weights are fitted, by likelihood gradients over whole segmentations, on the
base spans of a bounded sample of documents and on the same spans rewritten in
the ways people write them (and spoilt ones, which are no entities). Everything
else reads every whole text, one row at a time; memory follows the longest text.

Defined results: a null text is the empty text and has no spans; repeated rows
have equal results; a null doc_id is kept; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
MAX_ATOMS = 24             # white space not counted
AROUND = 3                 # white-space separated tokens kept on either side of a place
TRAIN_DOCS = 1500
TRAIN_REGIONS = 700
TRAIN_CHARS = 50_000       # longer documents are not learnt from
EPOCHS = 40

Span = tuple[str, int, int]


# Base spans -------------------------------------------------------------------------

def digits_of(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    if kind == "card":
        d = digits_of(found)
        return 13 <= len(d) <= 19 and luhn(d)
    return kind != "phone" or 9 <= len(digits_of(found)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The email pattern, looked for only around @ signs: a match that begins
    anywhere in the run of name characters before one needs that very sign."""
    pattern, least, at = PATTERNS["email"], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > least and (text[begin - 1] in "._%+-" or text[begin - 1].isascii() and text[begin - 1].isalnum()):
            begin -= 1
        m = pattern.match(text, begin) if begin < at else None
        if m:
            yield m.span()
            least = m.end()
        at = text.find("@", max(at + 1, least))


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind as listed, then start."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for kind in KINDS[1:]:
            if kind == "phone" and "+" not in text:
                continue
            out += [(kind, *m.span()) for m in PATTERNS[kind].finditer(text) if _holds(kind, m.group())]
    return out


_DIGIT = re.compile("[0-9]")


# Candidates ---------------------------------------------------------------------------

_PLACE = re.compile(r"[0-9@]+|[\[({] ?(?:at|dot) ?[\])}]|(?<=\s)dot(?=\s)", re.IGNORECASE)
_ATOM = re.compile(r"[^\W_]+|\s+|.", re.DOTALL)
# "at" and "dot" are words of their own or stand in brackets; a point with white
# space on one side ends a sentence
_ADDRESS = re.compile(r"[\w.%+-]+(?:\s?@\s?|\sat\s|\s?[\[({]\s?(?:at|@)\s?[\])}]\s?)"
                      r"[\w-]+(?:(?:\.|\s\.\s|\sdot\s|\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?)[\w-]+)+", re.IGNORECASE)
# one more label of a host
_LABEL = re.compile(r"(?:\.|\s\.\s|\sdot\s|\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?)[\w-]", re.IGNORECASE)
_QUAD = re.compile(r"(\d{1,3})\s?[\[(]?\.[\])]?\s?(\d{1,3})\s?[\[(]?\.[\])]?\s?(\d{1,3})\s?[\[(]?\.[\])]?\s?(\d{1,3})",
                   re.ASCII)
_NUMBER = re.compile(r"\+?\d{0,3}[\s.-]?\(?\d{2,4}\)?[\s.-]?\d{3}[\s.-]?\d{3,4}", re.ASCII)
_GROUPS = re.compile(r"\d{4}(?:[\s.-]?\d{4}){2,3}[\s.-]?\d{1,4}", re.ASCII)
_CUES = {"cue_email": ("mail", "courriel", "correo"), "cue_ip": ("ip", "host", "server"),
         "cue_card": ("card", "visa", "karte", "carte", "tarjeta"), "cue_phone": ("phone", "tel", "call", "fon")}
_DIGIT_STEPS = (1, 4, 7, 9, 10, 11, 13, 16, 17, 20)
FEATURES = (["bias"] + [f"digits_{k}" for k in range(len(_DIGIT_STEPS) + 1)]
            + ["address", "at_sign", "quad", "quad_over", "luhn", "no_luhn", "number", "groups", "plus", "paren",
               "only_number", "letters", "glued_left", "glued_right", "goes_on", "odd_edge", "unpaired", "wide", *_CUES])
_F = {f: k for k, f in enumerate(FEATURES)}


def span_features(text: str, s: int, e: int) -> list[int]:
    """Numbers of the active features of a candidate span."""
    seg = text[s:e]
    digits = digits_of(seg)
    names = ["bias", f"digits_{sum(len(digits) >= x for x in _DIGIT_STEPS)}"]
    if "@" in seg:
        names.append("at_sign")
    if not seg[0].isspace() and _ADDRESS.fullmatch(seg):
        names.append("address")
    quad = _QUAD.fullmatch(seg)
    if quad:
        names.append("quad" if all(int(x) <= 255 for x in quad.groups()) else "quad_over")
    if 13 <= len(digits) <= 19:
        names.append("luhn" if luhn(digits) else "no_luhn")
    letters = any(map(str.isalpha, seg))
    if letters:
        names.append("letters")
    elif not quad and all(c in "0123456789 .-()+" for c in seg):
        names.append("only_number")
    if _NUMBER.fullmatch(seg):
        names.append("number")
    if _GROUPS.fullmatch(seg):
        names.append("groups")
    if seg[0] == "+":
        names.append("plus")
    if "(" in seg:
        names.append("paren")
    if seg.count("(") != seg.count(")") or seg.count("[") != seg.count("]"):
        names.append("unpaired")
    before, after = text[max(0, s - 1):s], text[e:e + 2]
    if before and (before.isalnum() or before in "@.+-_%"):
        names.append("glued_left")
    if after and (after[0].isalnum() or after[0] in "@_" or (after[0] in ".-" and after[1:].isalnum())):
        names.append("glued_right")
    if letters and _LABEL.match(text, e):
        names.append("goes_on")
    if not (seg[0].isalnum() or seg[0] in "+(") or not (seg[-1].isalnum()):
        names.append("odd_edge")
    if "  " in seg or "\n" in seg:
        names.append("wide")
    cue = text[max(0, s - 16):s].lower()
    names += [c for c, ws in _CUES.items() if any(w in cue for w in ws)]
    return [_F[n] for n in names]


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of text around the places that could belong to personal
    data: AROUND tokens on either side, joined where they meet."""
    out: list[tuple[int, int]] = []
    for m in _PLACE.finditer(text):
        a, b = m.span()
        if out and a < out[-1][1]:
            a = out[-1][0]
        else:
            for _ in range(AROUND + 1):
                while a > 0 and not text[a - 1].isspace():
                    a -= 1
                if _ < AROUND:
                    while a > 0 and text[a - 1].isspace():
                        a -= 1
        for _ in range(AROUND + 1):
            while b < len(text) and not text[b].isspace():
                b += 1
            if _ < AROUND:
                while b < len(text) and text[b].isspace():
                    b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


@dataclass
class Lattice:
    """Candidates of a region: atom bounds as places in the text, and per
    candidate its first atom, end atom and active features."""
    places: list[int]
    spans: list[tuple[int, int]]
    feats: list[list[int]]


def lattice(text: str, begin: int, end: int) -> Lattice | None:
    """None where no candidate could be an entity: fewer than seven digits,
    no address sign and no written-out address in the region."""
    part = text[begin:end]
    if "@" not in part and sum(c.isdigit() for c in part) < 4 and not _ADDRESS.search(part):
        return None
    places = [begin + m.start() for m in _ATOM.finditer(part)] + [end]
    n = len(places) - 1
    atoms = [text[places[i]:places[i + 1]] for i in range(n)]
    opens = [a[0].isalnum() or a in "+(" for a in atoms]
    closes = [a[0].isalnum() for a in atoms]
    digits = np.concatenate(([0], np.cumsum([sum("0" <= c <= "9" for c in a) for a in atoms])))
    sign = np.concatenate(([0], np.cumsum([a == "@" or a.lower() in ("at", "dot") for a in atoms])))
    solid = np.concatenate(([0], np.cumsum([not a.isspace() for a in atoms])))
    spans: list[tuple[int, int]] = []
    feats: list[list[int]] = []
    for i in range(n):
        if not opens[i]:
            continue
        for j in range(i + 1, int(np.searchsorted(solid, solid[i] + MAX_ATOMS, side="right"))):
            if not closes[j - 1] or (digits[j] - digits[i] < 4 and sign[j] == sign[i]):
                continue
            if digits[j] - digits[i] > 19 and sign[j] == sign[i]:
                break
            f = span_features(text, places[i], places[j])
            if _POSSIBLE.isdisjoint(f):
                continue
            spans.append((i, j))
            feats.append(f)
    return Lattice(places, spans, feats) if spans else None


# Without one of these a candidate is of no kind.
_POSSIBLE = frozenset(_F[x] for x in ("address", "at_sign", "quad", "luhn", "number", "groups", "only_number"))


# The model -----------------------------------------------------------------------------

def _paths(lat: Lattice, scores: np.ndarray) -> tuple[list[float], list[float], list[list[int]]]:
    """Forward and backward log sums over all segmentations; candidates by end."""
    n = len(lat.places) - 1
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    starts: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (i, j) in enumerate(lat.spans):
        ends[j].append(c)
        starts[i].append(c)
    inside = np.logaddexp.reduce(scores, axis=1).tolist()     # over kinds
    fwd, bwd = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        fwd[j] = _logsum([fwd[j - 1]] + [fwd[lat.spans[c][0]] + inside[c] for c in ends[j]])
    for i in range(n - 1, -1, -1):
        bwd[i] = _logsum([bwd[i + 1]] + [bwd[lat.spans[c][1]] + inside[c] for c in starts[i]])
    return fwd, bwd, ends


def _logsum(xs: list[float]) -> float:
    if len(xs) == 1:
        return xs[0]
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


@dataclass
class SemiCrf:
    weights: np.ndarray           # kinds x features

    def scores(self, lat: Lattice) -> np.ndarray:
        return np.array([self.weights[:, f].sum(axis=1) for f in lat.feats])

    def best(self, lat: Lattice) -> list[Span]:
        """The best segmentation's entities (Viterbi over atoms)."""
        s = self.scores(lat)
        top, kind = s.max(axis=1).tolist(), s.argmax(axis=1).tolist()
        n = len(lat.places) - 1
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        for c, (_, j) in enumerate(lat.spans):
            ends[j].append(c)
        value, back = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for c in ends[j]:
                v = value[lat.spans[c][0]] + top[c]
                if v > value[j] + 1e-12:
                    value[j], back[j] = v, c
        out: list[Span] = []
        j = n
        while j > 0:
            c = back[j]
            if c < 0:
                j -= 1
            else:
                out.append((KINDS[kind[c]], lat.places[lat.spans[c][0]], lat.places[lat.spans[c][1]]))
                j = lat.spans[c][0]
        return out[::-1]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans, by kind as listed, then start."""
        base = base_spans(text)
        added: list[Span] = []
        for a, b in regions(text):
            lat = lattice(text, a, b)
            if lat:
                added += [x for x in self.best(lat) if not any(x[1] < e and s < x[2] for _, s, e in base if e > a and s < b)]
        order = sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
        return base, order


def fit_weights(samples: list[tuple[str, list[Span]]], epochs: int = EPOCHS, ridge: float = 2e-3) -> SemiCrf:
    """Likelihood gradients (Adam) over the segmentations of sample texts."""
    model = SemiCrf(np.zeros((len(KINDS), len(FEATURES))))
    model.weights[:, _F["bias"]] = -4.0
    data = []
    for text, gold in samples:
        for a, b in regions(text):
            lat = lattice(text, a, b)
            if not lat:
                continue
            where = {(lat.places[i], lat.places[j]): c for c, (i, j) in enumerate(lat.spans)}
            truth = [(where[s, e], KINDS.index(k)) for k, s, e in gold if (s, e) in where]
            hot = np.zeros((len(lat.spans), len(FEATURES)))
            for c, f in enumerate(lat.feats):
                hot[c, f] = 1.0
            data.append((lat, truth, hot))
    if not data:
        return model
    m, v = np.zeros_like(model.weights), np.zeros_like(model.weights)
    for epoch in range(1, epochs + 1):
        grad = np.zeros_like(model.weights)
        for lat, truth, hot in data:
            s = hot @ model.weights.T
            fwd, bwd, _ = _paths(lat, s)
            outer = np.array([fwd[i] + bwd[j] for i, j in lat.spans]) - fwd[-1]
            expected = np.exp(s + outer[:, None])
            for c, k in truth:
                expected[c, k] -= 1.0
            grad -= expected.T @ hot
        grad = grad / len(data) - ridge * model.weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        model.weights += 0.3 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return model


# Sample ----------------------------------------------------------------------------------

def rewritten(kind: str, found: str, turn: int) -> tuple[str, bool]:
    """A span as people also write it, and whether it still is one."""
    d = digits_of(found)
    if kind == "email":
        name, _, host = found.partition("@")
        host = "mail." * (turn // 4 % 2) + host
        return (f"{name} at {host.replace('.', ' dot ')}", f"{name} [at] {host}", f"{name}@{host}",
                f"{name} (at) {host.replace('.', ' (dot) ')}")[turn % 4], True
    if kind == "ip":
        parts = found.split(".")
        return (".".join(parts), "[.]".join(parts), ".".join([str(256 + int(parts[0]) % 700), *parts[1:]]),
                ".".join(parts[:3]))[turn % 4], turn % 4 < 2
    if kind == "card":
        spoilt = d[:-1] + str((int(d[-1]) + 1 + turn % 9) % 10)
        fours = [d[k:k + 4] for k in range(0, len(d), 4)]
        return (".".join(fours), "-".join(fours), spoilt, spoilt[:8])[turn % 4], turn % 4 < 2
    tail = d[-10:]
    return (f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}",
            f"{tail[:3]}.{tail[3:6]}.{tail[6:]}", tail if turn // 4 % 2 else tail[:5])[turn % 4], turn % 4 < 3


def samples_of(texts: list[str]) -> list[tuple[str, list[Span]]]:
    """Regions of sample texts with their base spans, and rewritten copies."""
    out: list[tuple[str, list[Span]]] = []
    for text in texts:
        base = base_spans(text)
        for a, b in regions(text):
            if lattice(text, a, b) is None:
                continue
            own = [(k, s - a, e - a) for k, s, e in base if a <= s and e <= b]
            # spans inside another one (digits of an address) are not truth for the model
            own = [x for x in own if not any(y != x and y[1] <= x[1] and x[2] <= y[2] for y in own)]
            out.append((text[a:b], own))
            turn, parts, at, shift, moved = len(out), [], 0, 0, []
            for kind, s, e in sorted(own, key=lambda x: x[1]):
                if s < at:
                    continue
                new, still = rewritten(kind, text[a + s:a + e], turn)
                parts += [text[a + at:a + s], new]
                if still:
                    moved.append((kind, s + shift, s + shift + len(new)))
                shift += len(new) - (e - s)
                at, turn = e, turn + 1
            if own:
                out.append(("".join(parts) + text[a + at:b], moved))
        if len(out) >= 2 * TRAIN_REGIONS:
            break
    return out


def sample_texts(docs: DataFrame, n: int = TRAIN_DOCS) -> DataFrame:
    """`h, text`: the `n` distinct texts of least hash among those with digits
    or address signs. Their number is estimated first; texts whose hash is above
    a bound that some 2 n of them lie below stay in their tasks, and copies meet
    in a partial aggregation: the limit sees about 2 n rows, whatever the input."""
    able = (docs.select("text").where(F.col("text").rlike("[0-9]{4}|@") & (F.length("text") <= TRAIN_CHARS))
            .select(F.xxhash64("text").alias("h"), "text"))
    there = able.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    if there > 2 * n:
        able = able.where(F.col("h") < -(1 << 63) + (1 << 64) * 2 * n // there)
    return able.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(n)


def fit(docs: DataFrame) -> SemiCrf:
    """From up to TRAIN_DOCS different documents with digits or address signs, by a
    hash of the text; at most 2 x TRAIN_REGIONS regions and their rewritten copies."""
    some = sample_texts(docs)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only what lies around the places that matter goes to the driver."""
        for batch in batches:
            texts = ["\n".join(t[a:b] for a, b in regions(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(texts, pa.string())], ["h", "text"])

    rows = some.mapInArrow(near, "h bigint, text string").orderBy("h", "text").collect()
    return fit_weights(samples_of([r["text"] for r in rows]))


def find(docs: DataFrame, model: SemiCrf) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)    # kinds x features numbers

    def joined(spans: list[Span]) -> str:
        return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            digest, every = [], []
            for text in batch.column("text").to_pylist():
                base, all_spans = m.spans(text or "")
                for k in KINDS:
                    counts[k].append(sum(x[0] == k for x in base))
                digest.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every.append(joined(all_spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(counts[k], pa.int64()) for k in KINDS],
                 pa.array(digest, pa.string()), pa.array(every, pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return base.mapInArrow(work, "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS)
                           + ", base_sha256 string, spans string")


def query(docs: DataFrame) -> DataFrame:
    return find(docs, fit(docs))
