"""Parameters: vocabularies and k-means settings.

A vocabulary is an ordered list of distinct terms; a term's position is part
of the result (tie order in rankings, coordinate in the posting vectors).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.fixed import (  # noqa: F401  (re-exported)
    DEFAULT_ETA, DEFAULT_K, DEFAULT_MAX_ITER, DEFAULT_SEED, DEFAULT_SPREAD, GLOBAL_SAMPLE_SPREAD,
    LANGUAGES,
)
from quarry.session import local_table, sql_literal

# Above this many terms a vocabulary is matched with a broadcast hash join on
# distinct tokens instead of an in-row set intersection with a literal array.
LITERAL_VOCAB_MAX = 64
# Up to this many terms the vocabulary table is broadcast to that join (its
# row count is the vocabulary length, known on the driver); a larger one is
# joined by shuffle, or broadcast only by Spark's own size check.
BROADCAST_VOCAB_MAX = 100_000


@dataclass(frozen=True)
class Vocabulary:
    terms: tuple[str, ...]

    def __post_init__(self) -> None:
        terms = tuple(self.terms)
        object.__setattr__(self, "terms", terms)
        if not terms:
            raise ValueError("vocabulary is empty")
        if any(not isinstance(t, str) or t == "" for t in terms):
            raise ValueError("vocabulary terms must be non-empty strings")
        if len(set(terms)) != len(terms):
            dup = sorted({t for t in terms if terms.count(t) > 1})
            raise ValueError(f"vocabulary terms must be distinct, repeated: {dup}")

    def __len__(self) -> int:
        return len(self.terms)

    def literal(self) -> Column:
        """The terms as one literal array column (position = index), built
        as one expression (one call to the JVM, whatever the length)."""
        return F.expr("array(" + ", ".join(sql_literal(t) for t in self.terms) + ")")

    def frame(self, spark: SparkSession) -> DataFrame:
        """`term string, pos int`; as many rows as terms (a parameter), as a
        local table."""
        return local_table(spark, {"term": "string", "pos": "int"},
                           [(t, i) for i, t in enumerate(self.terms)])

    def position(self, value: Column) -> Column:
        """0-based position of the first equal term, null when absent."""
        return F.nullif(F.array_position(self.literal(), value), F.lit(0)).cast("int") - F.lit(1)

    def label(self, pos: Column) -> Column:
        return F.element_at(self.literal(), pos.cast("int") + F.lit(1))


@dataclass(frozen=True)
class KMeansParams:
    spread: int = DEFAULT_SPREAD
    k: int = DEFAULT_K
    eta: float = DEFAULT_ETA
    max_iter: int = DEFAULT_MAX_ITER
    seed: int = DEFAULT_SEED

    def __post_init__(self) -> None:
        if self.spread <= 0:
            raise ValueError("spread must be positive, or tags cannot be recovered from x")
        if self.k < 1:
            raise ValueError("k must be at least 1")
        if self.max_iter <= 0:
            raise ValueError("max_iter must be positive")


LANGUAGE_VOCABULARY = Vocabulary(LANGUAGES)
