"""Line text scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column `value string` (files split by Spark)."""
    return spark.read.text(path)
