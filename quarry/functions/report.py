"""Fixed-width cluster report line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.fixed import REPORT_HEADER, REPORT_LINE  # noqa: F401  (re-exported)


def report_line(median_score: str = "median_score", tag: str = "tag",
                pct: str = "pct", size: str = "size") -> Column:
    return F.format_string(REPORT_LINE, F.col(median_score), F.col(tag), F.col(pct), F.col(size))
