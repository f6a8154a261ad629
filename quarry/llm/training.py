"""Rows a classifier is fitted on, and the small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD = 3, 1
TASKS = 16        # that keep and read a sample: its size is bounded


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: fold 1 is held out. A null id is held out."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(FOLDS)), F.lit(HELD))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == HELD


def training_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: tuple[int, int],
                   max_chars: int, seed: int = 7) -> DataFrame:
    """`_text`, `_label` (0 or 1) of a bounded sample of the labelled rows that
    may be learnt from: up to per_class[y] distinct texts of each label, by a
    seeded hash of the id; texts over max_chars are not learnt from. A text
    with both labels, or a null one, is left out."""
    known = (labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col(label).isin(0, 1))
             .select(F.col("doc_id").cast("bigint").alias("_id"), F.col(label).cast("int").alias("_label"))
             .distinct())
    picked = None
    for y in (0, 1):
        # some texts turn out equal or too long, so a few more ids are drawn
        some = (known.where(F.col("_label") == y).orderBy(F.xxhash64(F.lit(seed), "_id"), "_id")
                .limit(per_class[y] + per_class[y] // 4))
        picked = some if picked is None else picked.unionByName(some)
    texts = (docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").alias("_text"))
             .join(F.broadcast(picked), "_id")       # at most 1.25 x per_class ids
             .where(F.col("_text").isNotNull() & (F.length("_text") <= max_chars)))
    one = (texts.groupBy(F.xxhash64("_text").alias("_h"))
           .agg(F.min("_text").alias("_text"), F.min("_label").alias("_label"), F.max("_label").alias("_most"))
           .where(F.col("_label") == F.col("_most")))
    return one.select("_text", "_label")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the intercept last, of a ridge logistic regression (Newton).
    Both classes weigh the same in total."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    if len(set(y.tolist())) < 2:
        w[-1] = 4.0 if len(y) and y[0] else -4.0
        return w
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + penalty * w
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
