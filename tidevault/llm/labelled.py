"""Labelled rows: which may teach, and how they meet their documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000  # of 16 bytes each


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, divisible by 5.

    A null id counts as the empty text.
    """
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def taught(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, text, y`` of the documents that may teach.

    Labels other than 0 and 1 are left out; of several labels of an id the largest counts.
    The labels are sent to the documents as long as they are few, which is checked; more of
    them are joined by a shuffle.
    """
    y = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    if labels.count() <= BROADCAST_ROWS:
        y = F.broadcast(y)
    return docs.select("doc_id", "text").join(y, "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w -= move * min(1.0, 5 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return w


def chance(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The regression's probabilities."""
    z = np.clip(x @ w[:-1] + w[-1], -30, 30)
    return 1 / (1 + np.exp(-z))
