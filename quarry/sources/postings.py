"""Posting lines: headerless comma-separated text, six fields, no quoting.

    posting_type, id, accepted_answer, parent_id, score[, tags]

Fields 2 and 3 may be empty (null); the sixth may be missing (null); fields
past the sixth are ignored. Quotes are ordinary characters, which is why this
is `split` over text lines and not the CSV reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import pinned

POSTING_COLUMNS = ("posting_type", "id", "accepted_answer", "parent_id", "score", "tags")
# --- Fixed value: a valid line. Integer fields 0, 1 and 4 are required, 2
# and 3 may be empty; anything may follow a fifth comma. The casts judge the
# range of the numbers.
LINE_PATTERN = r"(?s)^[+-]?[0-9]+,[+-]?[0-9]+,([+-]?[0-9]+)?,([+-]?[0-9]+)?,[+-]?[0-9]+(,.*)?$"
# ---------------------------------------------------------------------------
_INT_FIELDS = (("posting_type", "int"), ("id", "bigint"), ("accepted_answer", "bigint"), ("parent_id", "bigint"),
               ("score", "bigint"))


def posting_line(df: DataFrame) -> Column:
    """Build a posting line from posting columns (the inverse of the parse)."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    head = F.concat_ws(",", *[text(c) for c in POSTING_COLUMNS[:5]])
    return F.when(F.col("tags").isNull(), head).otherwise(F.concat(head, F.lit(","), F.col("tags")))


def parse_postings(lines: DataFrame, *, value: str = "value", mode: str = "strict"):
    """Parse posting lines.

    mode="strict": a missing, non-integer or out-of-range field fails the job.
    mode="lenient": returns ``(postings, rejects)``.

    A line is split once and its numbers are cast once, pinned to the row; the
    check and the columns read them there. The check is a filter
    (which survives column pruning; a check inside an output column would be
    dropped with the column): the layout by one anchored pattern, the range of the
    numbers by the cast.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"unknown mode {mode!r}")
    read = pinned(lines.select(F.col(value).alias("_v")), _line=F.col("_v"))
    read = pinned(read, _f=F.split("_line", ",", 7))
    field = lambda i: F.get("_f", F.lit(i))
    # empty fields are not cast: a cast that fails is dear
    read = pinned(read, **{name: F.nullif(field(i), F.lit("")).try_cast(typ) for i, (name, typ) in enumerate(_INT_FIELDS)})
    ok = F.col("_line").rlike(LINE_PATTERN)
    for i, (name, _) in enumerate(_INT_FIELDS):
        # the layout has seen to it that only optional fields are empty
        ok = ok & (F.col(name).isNotNull() | (field(i) == ""))
    ok = F.coalesce(ok, F.lit(False))
    # an empty sixth field is "no tag" only when nothing but commas follows it
    none = (field(5) == "") & (F.rtrim(F.coalesce(field(6), F.lit("")), F.lit(",")) == "")
    columns = [*[F.col(name) for name, _ in _INT_FIELDS], F.when(~none, field(5)).alias("tags")]
    if mode == "strict":
        err = F.raise_error(F.concat(F.lit("malformed posting line: "), F.coalesce(F.substring("_line", 1, 80), F.lit("null"))))
        return read.where(F.when(ok, F.lit(True)).otherwise(err)).select(*columns)
    return read.where(ok).select(*columns), read.where(~ok).select(F.col("_line").alias(value))
