"""Running document counts per vocabulary term over a folder of article-line
files. State is one count per vocabulary term (bounded by the vocabulary);
Spark keeps it in the state store under the query's checkpoint location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.terms import term_hits
from quarry.params import Vocabulary
from quarry.sources.articles import parse_articles


def term_counts_stream(spark: SparkSession, folder: str, vocab: Vocabulary, *,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame `term, n`: articles mentioning each term so far.
    Use with output mode "complete" (or "update")."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    articles = parse_articles(reader.load(folder))
    return term_hits(articles, vocab).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
