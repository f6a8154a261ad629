"""Time-use summary over a wide survey table: columns classified by name
prefix into primary needs, work and other; respondents recoded by working
status, sex and age; minutes summed to hours per class; mean hours per
(working, sex, age) group, through the DataFrame API, through SQL text over a
temporary view, and through a schema-enforced ("typed") form.

The recodes are `when` expressions, so the filter on `telfs` reaches the
parquet scan and only the classified columns are read. The grouping has a
handful of keys; the means are partial per task (exact sums and a count), so a
group holding most respondents shuffles one row per task, and a mean does not
depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.fixed import MAX_EMPLOYABLE_STATUS, OTHER_PREFIXES, PRIMARY_PREFIXES, WORK_PREFIXES
from quarry.functions.numeric import exact_mean, exact_mean_sql
from quarry.functions.recode import age_group, hours_sum, sex_label, working_status
from quarry.session import local_table

GROUP_KEYS = ("working", "sex", "age")
MEASURES = ("primaryNeeds", "work", "other")
# Names and types are enforced; fields stay nullable because parquet and CSV
# readers mark every column nullable (`to()` refuses to narrow that).
TIME_USAGE_ROW = T.StructType([
    T.StructField("working", T.StringType(), True),
    T.StructField("sex", T.StringType(), True),
    T.StructField("age", T.StringType(), True),
    T.StructField("primaryNeeds", T.DoubleType(), True),
    T.StructField("work", T.DoubleType(), True),
    T.StructField("other", T.DoubleType(), True),
])
CLASSES = (("primary", PRIMARY_PREFIXES), ("work", WORK_PREFIXES), ("other", OTHER_PREFIXES))


def column_class(name: str) -> str | None:
    """The first class whose prefixes match the name, else None."""
    for label, prefixes in CLASSES:
        if any(name.startswith(p) for p in prefixes):
            return label
    return None


def classify_columns(names: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """(primary, work, other) column names, input order kept; a name goes to
    the first class it matches; unmatched names are dropped."""
    out: dict[str, list[str]] = {label: [] for label, _ in CLASSES}
    for n in names:
        label = column_class(n)
        if label is not None:
            out[label].append(n)
    return out["primary"], out["work"], out["other"]


def classify_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The same classification as data: `pos, name, class` (null = unmatched),
    one `when` chain of `startswith` tests per name."""
    rows = local_table(spark, {"pos": "int", "name": "string"}, [(i, n) for i, n in enumerate(names)])
    label = F.lit(None).cast("string")
    for cls, prefixes in reversed(CLASSES):
        test = F.lit(False)
        for p in prefixes:
            test = test | F.col("name").startswith(p)
        label = F.when(test, F.lit(cls)).otherwise(label)
    return rows.select("pos", "name", label.alias("class"))


def recoded(df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """`*keep, working, sex, age` for every row."""
    return df.select(*keep, working_status().alias("working"), sex_label().alias("sex"),
                     age_group().alias("age"))


def activity_hours(df: DataFrame, primary: Sequence[str], work: Sequence[str],
                   other: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """`*keep, primaryNeeds, work, other`: hours per class for every row."""
    return df.select(*keep, hours_sum(primary, "primary").alias("primaryNeeds"),
                     hours_sum(work, "work").alias("work"),
                     hours_sum(other, "other").alias("other"))


def respondent_summary(df: DataFrame, primary: Sequence[str], work: Sequence[str],
                       other: Sequence[str]) -> DataFrame:
    """Employable respondents (telfs <= 4): `working, sex, age, primaryNeeds,
    work, other`."""
    return (df.where(F.col("telfs") <= F.lit(MAX_EMPLOYABLE_STATUS))
            .select(working_status().alias("working"), sex_label().alias("sex"),
                    age_group().alias("age"),
                    hours_sum(primary, "primary").alias("primaryNeeds"),
                    hours_sum(work, "work").alias("work"),
                    hours_sum(other, "other").alias("other")))


def summary_grouped(summed: DataFrame) -> DataFrame:
    """Mean hours per (working, sex, age), rounded to one decimal, sorted."""
    return (summed.groupBy(*GROUP_KEYS)
            .agg(*[F.round(exact_mean(m), 1).alias(m) for m in MEASURES])
            .orderBy(*GROUP_KEYS))


def grouped_sql_text(relation: str) -> str:
    keys = ", ".join(GROUP_KEYS)
    means = ", ".join(f"round({exact_mean_sql(m)}, 1) AS {m}" for m in MEASURES)
    return f"SELECT {keys}, {means} FROM {relation} GROUP BY {keys} ORDER BY {keys}"


def summary_grouped_sql(summed: DataFrame) -> DataFrame:
    """`summary_grouped` as SQL text. The frame is bound as a parameter of the
    text, so no view of the caller's is replaced."""
    return summed.sparkSession.sql(grouped_sql_text("{summed}"), summed=summed)


def summary_typed(summed: DataFrame) -> DataFrame:
    """Rows forced to the fixed row schema by name (reordered, cast; a
    missing column is an error, where `to()` alone would fill in nulls)."""
    missing = [f.name for f in TIME_USAGE_ROW.fields if f.name not in summed.columns]
    if missing:
        raise ValueError(f"columns missing for the time-usage row: {missing}")
    return summed.to(TIME_USAGE_ROW)


def summary_grouped_typed(typed: DataFrame) -> DataFrame:
    """`summary_grouped` on schema-enforced rows, with a schema-enforced result."""
    return summary_grouped(summary_typed(typed)).to(TIME_USAGE_ROW)
