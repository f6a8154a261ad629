"""Article lines: a fixed-width opening wrapper, the title, a marker, the text
and a fixed-width closing wrapper, all on one line.

Offsets are in characters. Parsing is pure column arithmetic (`locate`,
`substr`, `char_length`), so it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.fixed import ARTICLE_MARKER as MARKER
from quarry.fixed import ARTICLE_PREFIX_LEN as PREFIX_LEN
from quarry.fixed import ARTICLE_SUFFIX_LEN as SUFFIX_LEN

# The wrappers `article_line` writes (14 and 16 characters; any text of those
# lengths parses the same).
OPEN_WRAPPER = "<page> <title>"
CLOSE_WRAPPER = "</text> </page> "


def article_line(title: Column, text: Column) -> Column:
    """Build an article line from title and text (the inverse of the parse)."""
    return F.concat(F.lit(OPEN_WRAPPER), title, F.lit(MARKER), text, F.lit(CLOSE_WRAPPER))


def _layout(value: Column, marker: str, prefix_len: int, suffix_len: int):
    i = F.locate(marker, value)                      # 1-based, 0 = absent
    n = F.char_length(value)
    text_start = i + F.lit(len(marker))              # 1-based first text char
    text_len = n - F.lit(suffix_len) - (text_start - F.lit(1))
    ok = (i > F.lit(prefix_len)) & (text_len >= F.lit(0))
    title = value.substr(F.lit(prefix_len + 1), i - F.lit(prefix_len + 1))
    text = value.substr(text_start, text_len)
    return ok, title, text


def parse_articles(lines: DataFrame, *, value: str = "value", mode: str = "strict",
                   marker: str = MARKER, prefix_len: int = PREFIX_LEN,
                   suffix_len: int = SUFFIX_LEN):
    """Parse article lines into `title, text` (other columns are kept).

    mode="strict": a line without the marker, or too short for the wrappers,
    fails the job, as in the reference.
    mode="lenient": returns ``(articles, rejects)``; rejects keep the line.
    """
    v = F.col(value)
    ok, title, text = _layout(v, marker, prefix_len, suffix_len)
    keep = [F.col(c) for c in lines.columns if c != value]
    if mode == "strict":
        # A filter, not a column: column pruning cannot drop the check.
        err = F.raise_error(F.concat(F.lit("malformed article line: "), F.substring(v, 1, 80)))
        return (lines.where(F.coalesce(F.when(~F.coalesce(ok, F.lit(False)), err), F.lit(True)))
                .select(*keep, title.alias("title"), text.alias("text")))
    if mode == "lenient":
        flagged = lines.withColumn("_ok", F.coalesce(ok, F.lit(False)))
        good = flagged.where("_ok").select(*keep, title.alias("title"), text.alias("text"))
        bad = flagged.where(~F.col("_ok")).drop("_ok")
        return good, bad
    raise ValueError(f"unknown mode {mode!r}")
