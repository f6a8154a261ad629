"""quarry: term ranking, posting scoring/clustering and time-use summaries as
Spark DataFrame jobs.

Layout:
  sources/    line, article, posting and wide-CSV readers; bindings to tables
  functions/  column expressions (tokens, recodes, distances, formatting)
  operators/  DataFrame -> DataFrame operators, one module per workload
  plans/      the named query registry and the SQL each query is checked against
  streaming/  the same term ranking over a file stream
"""

from quarry.params import KMeansParams, Vocabulary

__all__ = ["KMeansParams", "Vocabulary"]
