"""Tokens and term matching.

A token is the text between single spaces: case is kept, punctuation sticks
to the word ("OK," is not "OK") and newlines or tabs do not split. Matching
counts documents, not occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.params import Vocabulary


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """array<string> of the space-separated tokens (empty tokens kept; no
    vocabulary term is empty, so they never match)."""
    # The pattern is one literal space; no regex metacharacter is involved.
    return F.split(_col(text), " ")


def mentions(text: Column | str, term: str) -> Column:
    """True when the text holds `term` as a whole token."""
    if not term:
        raise ValueError("term must be non-empty")
    return F.array_contains(tokens(text), F.lit(term))


def vocabulary_hits(text: Column | str, vocab: Vocabulary) -> Column:
    """Distinct vocabulary terms the text mentions, in first-token order."""
    return F.array_intersect(tokens(text), vocab.literal())


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with columns that are computed once per row, however often they are
    used. A projection's expression is copied into every filter above it that
    names the column; a generator's output is not, so the columns are made as the
    one row of an inlined array. It is compiled with its neighbours."""
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
