"""Quality rules by weak supervision.

Every rule looks at a few counts of a document and votes good (1), bad (0) or
abstains (-1). Rules are not trusted equally: expectation-maximisation over
all documents estimates how often good documents are and, per rule, how
accurate its votes are: how often a vote it casts says "bad" on good and on
bad documents. Abstaining carries no weight. The posterior probability of
"good" given all votes replaces the all-must-pass filter.

Plan. One pass over the texts makes the counts (array functions inside the
row, no shuffle). Vote patterns are then counted: partial + final aggregation,
at most 3**(number of rules) rows whatever the input. The rounds of the
expectation-maximisation are one aggregate each over those patterns; only the
rule rates (a few numbers per rule) come to the driver. The posterior is an
expression over the votes with the rates as literals: no join.

Defined results: a null text has no words; an empty table gives an empty
result; rows are judged one by one, so repeated rows get equal results; a null
doc_id is kept; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, cut, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
BLOCK = 100        # words of a stretch whose variety is looked at


@dataclass(frozen=True)
class Rates:
    """What the rounds estimate: P(good), and per rule P(the vote is bad |
    it votes, the document is good) and the same for a bad document."""
    good: float
    objects: tuple[tuple[float, float], ...]


# Counts of words in repeated windows ----------------------------------------

def _repeat_words(ws: str) -> str:
    """SQL: how many words of array `ws` lie in a window of five words that
    occurs twice or more in the same array (the first occurrence included).

    Windows are 64-bit hashes. The sorted hashes tell cheaply whether any
    repeats; only then are (hash, position) pairs sorted, the repeated
    positions taken, and the words they cover counted as the lengths of the
    union of [p, p+5): n log n, never n x n."""
    n = f"size({ws})"
    hashed = (f"transform(sequence(0, {n} - {WINDOW}), i -> xxhash64("
              + ", ".join(f"{ws}[i + {k}]" if k else f"{ws}[i]" for k in range(WINDOW)) + "))")
    return (f"CASE WHEN {n} < {WINDOW + 1} THEN 0L ELSE "
            f"aggregate(array({hashed}), 0L, (z, hs) -> "
            f"CASE WHEN size(array_distinct(hs)) = size(hs) THEN 0L ELSE {_covered('hs')} END) END")


def _covered(hs: str) -> str:
    pairs = f"sort_array(transform({hs}, (h, p) -> struct(h AS h, p AS p)))"
    # positions of windows whose hash equals a neighbour's in sorted order
    repeated = (f"aggregate(array({pairs}), cast(array() AS array<int>), (z, s) -> "
                "sort_array(transform(filter(s, (x, i) -> "
                "(i > 0 AND s[greatest(i - 1, 0)].h = x.h) OR "
                "(i < size(s) - 1 AND s[least(i + 1, size(s) - 1)].h = x.h)), x -> x.p)))")
    # a window covers up to the next repeated position, five words at most
    return (f"aggregate(array({repeated}), 0L, (z, ps) -> "
            f"aggregate(transform(ps, (p, i) -> CASE WHEN i = size(ps) - 1 THEN {WINDOW} "
            f"ELSE least({WINDOW}, ps[least(i + 1, size(ps) - 1)] - p) END), 0L, (a, b) -> a + b))")


def _block_distinct(ws: str) -> str:
    """SQL: distinct words of every stretch of BLOCK words, summed up. Unlike
    the distinct words of a whole text, its share of the words does not fall
    with the length of a text."""
    return (f"CASE WHEN size({ws}) = 0 THEN 0L ELSE aggregate(sequence(0, (size({ws}) - 1) div {BLOCK}), 0L, "
            f"(z, k) -> z + size(array_distinct(slice({ws}, cast(k * {BLOCK} + 1 AS int), {BLOCK})))) END")


def counts(docs: DataFrame) -> DataFrame:
    """`doc_id` and the counts the rules look at, one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # the words travel as one array column, computed once per row
    base = docs.select("doc_id", text.alias("_t"), words(text).alias("_w"))
    lines = F.filter(F.split("_t", "\n", -1),
                     lambda l: F.length(F.translate(l, SPACES, "")) > 0)
    solid = F.translate("_t", SPACES, "")
    word_hashes = F.transform("_w", lambda w: F.xxhash64(w))
    return (base.withColumn("_w", word_hashes)
            .select(
                "doc_id",
                F.size("_w").cast("bigint").alias("n_words"),
                F.length(solid).cast("bigint").alias("word_chars"),
                (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
                F.size(lines).cast("bigint").alias("n_lines"),
                F.expr(_repeat_words("_w")).alias("n_repeat_words"),
                F.expr(_block_distinct("_w")).alias("n_block_distinct"),
                F.length(F.translate("_t", "!", "")).cast("bigint").alias("_no_bang"),
                F.length("_t").cast("bigint").alias("n_chars"),
                F.length(F.regexp_replace("_t", r"[^\p{Lu}]+", "")).cast("bigint").alias("n_upper"),
                F.length(F.regexp_replace("_t", r"[^\p{L}\p{N}]+", "")).cast("bigint").alias("n_alnum"),
            )
            .withColumn("n_bangs", F.col("n_chars") - F.col("_no_bang")).drop("_no_bang"))


# Rules ------------------------------------------------------------------------

def _vote(bad: Column, good: Column | None = None) -> Column:
    """Without a condition for good the rule only ever objects: that a text
    lacks one defect is no evidence that it is good."""
    v = F.when(bad, 0)
    return (v if good is None else v.when(good, 1)).otherwise(-1).cast("tinyint")


def rules() -> dict[str, Column]:
    """name -> vote (0 bad, 1 good, -1 abstains) over the columns of `counts`."""
    c = F.col
    n, chars = c("n_words"), c("word_chars")
    return {
        "length": _vote(n < 10),
        "mean_word": _vote((chars < 2 * n) | (chars > 15 * n)),
        "symbols": _vote(c("n_symbols") > 0.1 * n, (n >= 20) & (c("n_symbols") <= 0.01 * n)),
        "alnum": _vote((n >= 20) & (c("n_alnum") < 0.89 * chars), (n >= 20) & (c("n_alnum") >= 0.93 * chars)),
        "bangs": _vote((n >= 10) & (c("n_bangs") > 0.2 * n)),
        "dup_lines": _vote((c("n_lines") >= 4) & (c("n_dup_lines") > 0.3 * c("n_lines"))),
        "repeats": _vote((n >= 10) & (c("n_repeat_words") > 0.2 * n), (n >= 50) & (c("n_repeat_words") <= 0.02 * n)),
        "variety": _vote((n >= 20) & (c("n_block_distinct") < 0.2 * n),
                         (n >= 20) & (c("n_block_distinct") > 0.4 * n)),
        "case": _vote((n >= 10) & (c("n_upper") > 0.5 * chars)),
    }


# Expectation-maximisation --------------------------------------------------------

def start_rates(n_rules: int) -> Rates:
    """To begin with, a vote for bad is believed to be rare on good documents
    and common on bad ones, the same for every rule."""
    return Rates(0.8, ((0.05, 0.7),) * n_rules)


def log_odds(votes: list[Column], r: Rates) -> Column:
    """log P(good | votes) - log P(bad | votes), from the rates as literals."""
    total = F.lit(math.log(r.good) - math.log1p(-r.good))
    for v, (on_good, on_bad) in zip(votes, r.objects):
        total = total + (F.when(v == 0, math.log(on_good) - math.log(on_bad))
                         .when(v == 1, math.log1p(-on_good) - math.log1p(-on_bad)).otherwise(0.0))
    return total


def posterior(votes: list[Column], r: Rates) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds(votes, r)))


def patterns(voted: DataFrame, names: list[str]) -> DataFrame:
    """Vote patterns with their number of documents: at most 3**len(names)
    rows, cut from the lineage."""
    return cut(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n_docs")), 1)


def fit(pats: DataFrame, names: list[str], rounds: int = 25, tolerance: float = 1e-6) -> Rates:
    """Rates by expectation-maximisation over the counted patterns. A tenth of
    a vote each way smooths them, so no rate is 0 or 1. A rule that comes out
    objecting more to good documents than to bad ones is given no weight: so
    the two classes cannot swap."""
    votes = [F.col(n) for n in names]
    r = start_rates(len(names))
    for _ in range(rounds):
        p, w = posterior(votes, r), F.col("n_docs")
        sums = [F.sum(w).alias("n"), F.sum(w * p).alias("g")]
        for i, v in enumerate(votes):
            for tag, hit in (("b", v == 0), ("v", v >= 0)):
                sums += [F.sum(F.when(hit, w).otherwise(0)).alias(f"n{tag}{i}"),
                         F.sum(F.when(hit, w * p).otherwise(0.0)).alias(f"g{tag}{i}")]
        s = pats.agg(*sums).first()
        if not s["n"]:
            return r

        def rate(i: int) -> tuple[float, float]:
            bad, voted, bad_g, voted_g = s[f"nb{i}"], s[f"nv{i}"], s[f"gb{i}"], s[f"gv{i}"]
            pair = ((bad_g + 0.1) / (voted_g + 0.2), (bad - bad_g + 0.1) / (voted - voted_g + 0.2))
            return ((bad + 0.1) / (voted + 0.2),) * 2 if pair[0] > pair[1] else pair

        new = Rates(min(max(s["g"] / s["n"], 1e-3), 1 - 1e-3), tuple(rate(i) for i in range(len(names))))
        moved = [abs(new.good - r.good)] + [abs(x - y) for p, q in zip(new.objects, r.objects) for x, y in zip(p, q)]
        done = max(moved) < tolerance
        r = new
        if done:
            break
    return r


def quality(docs: DataFrame, threshold: float = 0.5, rounds: int = 25) -> DataFrame:
    """One row per document: the counts, `base_failed`, every rule's vote
    (`vote_<rule>`), `p_good` (posterior probability of good) and `kept`
    (not base_failed and p_good >= threshold)."""
    named = rules()
    names = [f"vote_{k}" for k in named]
    counted = counts(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    # counts and votes are a few numbers per document: written once, so the
    # rounds and the result do not read the texts again
    voted = cut(counted.withColumns({"base_failed": failed} | {f"vote_{k}": v for k, v in named.items()}))
    rates = fit(patterns(voted, names), names, rounds)
    return (voted.withColumn("p_good", posterior([F.col(n) for n in names], rates))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def query(docs: DataFrame) -> DataFrame:
    q = quality(docs)
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "p_good"]
    return q.select(*first, *[c for c in q.columns if c.startswith("vote_")])
