"""The registered queries of this subpackage and the SQL of those that SQL can
express. Each query applies its operator, with production parameters, to the
whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (bpe, context_tree, fill_middle, fingerprints, line_crf, line_dedup, mixing, ngram_join, pii,
                        quality_rules, sharding, toxicity, word_runs)
from quarry.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _on_documents(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(table(spark, sf_dir, "documents"))


def _with_labels(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": _on_documents(quality_rules.query),
        "op2_fingerprints": _on_documents(fingerprints.query),
        "op3_sharding": _on_documents(sharding.query),
        "op4_toxicity": _with_labels(toxicity.query),
        "op5_mixing": _on_documents(mixing.query),
        "op6_quality_crf": _with_labels(line_crf.query),
        "op7_line_dedup": _on_documents(line_dedup.query),
        "op8_pii": _on_documents(pii.query),
        "op9_bpe": _on_documents(bpe.query),
        "op10_ngram_join": _on_documents(ngram_join.query),
        "op11_fill_middle": _on_documents(fill_middle.query),
        "op12_context_tree": _on_documents(context_tree.query),
        "op13_word_runs": _on_documents(word_runs.query),
    }


def oracle_sql() -> dict[str, str]:
    return {}
