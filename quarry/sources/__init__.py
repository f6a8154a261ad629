"""Readers: text lines, article lines, posting lines, wide CSV, and the
bindings of those shapes to the driver's parquet tables."""

from quarry.sources.articles import article_line, parse_articles
from quarry.sources.postings import parse_postings, posting_line
from quarry.sources.text import read_lines
from quarry.sources.wide import parse_wide_lines, read_wide_csv, wide_schema

__all__ = [
    "article_line", "parse_articles", "parse_postings", "parse_wide_lines",
    "posting_line", "read_lines", "read_wide_csv", "wide_schema",
]
