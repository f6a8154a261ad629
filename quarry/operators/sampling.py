"""Seed selection for k-means.

Samples are ordered by a hash of (seed, id), so they are uniform over the
points, repeatable, and independent of arrival order or partitioning. The
per-tag sample is `row_number() <= m` over a window by tag; Spark plans it
with a partial group limit before the shuffle, so each task sends at most m
rows per tag and no task ever holds a whole tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import trunc_div
from quarry.params import GLOBAL_SAMPLE_SPREAD, KMeansParams


def hash_order(seed: int, id_col: str = "id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def sample_per_tag(vectors: DataFrame, params: KMeansParams, n_tags: int) -> DataFrame:
    """`k, id, x, y`: k / n_tags points of every tag; k = tag position * m + rank."""
    if params.k % n_tags != 0:
        raise ValueError(f"k={params.k} must be a multiple of the number of tags ({n_tags})")
    m = params.k // n_tags
    w = Window.partitionBy("x").orderBy(hash_order(params.seed), F.col("id"))
    ranked = vectors.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= m)
    k = trunc_div(F.col("x"), F.lit(params.spread)) * F.lit(m) + F.col("_rn") - F.lit(1)
    return ranked.select(k.cast("int").alias("k"), "id", "x", "y")


def sample_global(vectors: DataFrame, n: int, seed: int) -> DataFrame:
    """`k, id, x, y`: exactly n points (fewer if there are fewer), without
    replacement, whatever their tag; a top-n, so each task sends n rows."""
    top = vectors.orderBy(hash_order(seed), F.col("id")).limit(n)
    w = Window.orderBy(hash_order(seed), F.col("id"))  # over the n chosen rows only
    return top.select((F.row_number().over(w) - 1).cast("int").alias("k"), "id", "x", "y")


def seed_sample(vectors: DataFrame, params: KMeansParams, n_tags: int) -> DataFrame:
    """Per-tag sample, or a global one when the spread is too small to tell
    tags apart."""
    if params.spread < GLOBAL_SAMPLE_SPREAD:
        return sample_global(vectors, params.k, params.seed)
    return sample_per_tag(vectors, params, n_tags)


def seed_centres(vectors: DataFrame, params: KMeansParams, n_tags: int) -> list[tuple[int, int]]:
    """The initial centres on the driver (k rows, k is a parameter), index =
    cluster id. Fails when a tag has fewer than k / n_tags points."""
    rows = seed_sample(vectors, params, n_tags).select("k", "x", "y").collect()
    if len(rows) != params.k:
        raise ValueError(f"seed sample has {len(rows)} points, expected k={params.k} "
                         "(some tag has too few points)")
    by_k = {r["k"]: (r["x"], r["y"]) for r in rows}
    if sorted(by_k) != list(range(params.k)):
        raise ValueError("seed sample does not cover every cluster index")
    return [by_k[i] for i in range(params.k)]
