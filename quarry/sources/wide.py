"""Wide survey CSV: a header line names the columns; the first column is a
string, every other column a double. Quotes are not special.

Files and lines go through one parser. Files are read with Spark's CSV reader as
lines (one column, named by the whole header): it skips every file's header and
compares it with the first one's, and splits files over tasks. A line is
split once, its numbers are cast once as an array, and the check, a filter that
column pruning cannot remove, and the columns take their elements.

Modes:
- "strict": a bad line fails the job, whichever columns are read;
- "lenient": `(rows, rejects)`;
- "permissive": every line a row; a bad one has its line in `_corrupt_record`,
  and null numbers where it has none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import pinned

CORRUPT = "_corrupt_record"
MODES = ("strict", "lenient", "permissive")
# Why a line is rejected, in the order in which it is judged.
FEW, MANY, MISSING, MALFORMED = "too few fields", "too many fields", "missing number", "malformed number"
# A separator of the line reader that no text file should hold; a line with it
# is still read whole, from the reader's own corrupt-record column.
_NO_SEPARATOR = "\x00\x01"
_LINE = {"quote": "", "sep": _NO_SEPARATOR, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}


def wide_schema(names: Sequence[str]) -> T.StructType:
    """First column string, all others double, none nullable."""
    names = list(names)
    if not names:
        raise ValueError("column names cannot be empty")
    fields = [T.StructField(names[0], T.StringType(), False)]
    fields += [T.StructField(n, T.DoubleType(), False) for n in names[1:]]
    return T.StructType(fields)


def header_names(header_line: str) -> list[str]:
    return header_line.split(",")


def read_wide_csv(spark: SparkSession, path: str | list[str], *, mode: str = "strict") -> tuple:
    """Read a wide CSV file (or a folder of them, each with its header).

    Returns the header names and the typed DataFrame; in lenient mode the
    names, the rows and the rejects. Every file's header is compared with the first
    one's, and another one fails the job in every mode. Blank lines are skipped.
    """
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"no header line in {path}")
    header = first[0]["value"]
    schema = T.StructType([T.StructField(header, T.StringType()), T.StructField(CORRUPT, T.StringType())])
    read = spark.read.csv(path, schema=schema, header=True, enforceSchema=False, columnNameOfCorruptRecord=CORRUPT, **_LINE)
    lines = read.toDF("value", CORRUPT).select(F.coalesce(CORRUPT, "value").alias("value"))
    return _parsed(lines, header_names(header), mode)


def parse_wide_lines(lines: DataFrame, *, value: str = "value", mode: str = "strict") -> tuple:
    """Same as `read_wide_csv` over a DataFrame of lines: the first line is the
    header, and lines equal to it are dropped (as Spark's CSV reader does for
    a dataset of lines)."""
    first = lines.select(value).limit(1).collect()
    if not first:
        raise ValueError("no header line")
    header = first[0][0]
    return _parsed(lines.select(F.col(value).alias("value")), header_names(header), mode, header)


def _read(lines: DataFrame, n: int) -> DataFrame:
    """`_line, _f, _x` from `value`: the line, its fields, and the number fields as
    doubles (null where one cannot be read): one split and one cast a line."""
    read = pinned(lines.select(F.col("value").alias("_v")), _line=F.col("_v"))
    read = pinned(read, _f=F.split("_line", ",", -1))
    return pinned(read, _x=F.slice("_f", 2, n - 1).try_cast("array<double>")) if n > 1 else read


def _number(i: int) -> Column:
    return F.get("_x", F.lit(i))


def _parsed(lines: DataFrame, names: list[str], mode: str, header: str | None = None) -> tuple:
    """`header`: lines equal to it, and blank ones, are skipped."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    n = len(names)
    read = _read(lines, n)
    line = F.col("_line")
    given = line.isNotNull()
    if header is not None:
        given = given & (line != header) & (line != "")
    good = F.size("_f") == n
    for i in range(n - 1):
        good = good & _number(i).isNotNull()
    columns = [F.get("_f", F.lit(0)).alias(names[0]), *[_number(i).alias(c) for i, c in enumerate(names[1:])]]
    if mode == "strict":
        err = F.raise_error(F.concat(F.lit("malformed wide line: "), F.substring(line, 1, 80)))
        judged = F.when(~given, F.lit(False)).when(good, F.lit(True)).otherwise(err)
        return names, read.where(judged).select(*columns)
    if mode == "permissive":
        return names, read.where(given).select(*columns, F.when(~good, line).alias(CORRUPT))
    return names, read.where(given & good).select(*columns), _rejects(read.where(given & ~good), names)


def _rejects(bad: DataFrame, names: Sequence[str]) -> DataFrame:
    """`line, reason, column`: the first of the four reasons that holds, and for
    the last two the first number column concerned."""
    n = len(names)
    blank = F.lit(None)
    unread = F.lit(None)
    for i in reversed(range(n - 1)):
        blank = F.when(F.trim(F.get("_f", F.lit(i + 1))) == "", F.lit(names[i + 1])).otherwise(blank)
        unread = F.when(_number(i).isNull(), F.lit(names[i + 1])).otherwise(unread)
    size = F.size("_f")
    reason = F.when(size < n, FEW).when(size > n, MANY).when(blank.isNotNull(), MISSING).otherwise(MALFORMED)
    column = F.when(size == n, F.coalesce(blank, unread))
    return bad.select(F.col("_line").alias("line"), reason.alias("reason"), column.cast("string").alias("column"))
