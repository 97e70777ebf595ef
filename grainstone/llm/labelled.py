"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: str, mod: int) -> Column:
    """crc32 of the key as text, mod `mod`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int, key: str = "doc_id") -> DataFrame:
    """(key, text, label) of at most `most` labelled rows of each of the classes 0 and 1.

    Rows are chosen by the order of a hash of the key, among those labels rows that are
    `usable` and have a label; a key that is labelled twice counts with its larger label.
    The chosen keys, 2 * most at the most, are the only thing that is broadcast.
    """
    known = labels.where(usable & F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    kept = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(most)
        kept = part if kept is None else kept.unionByName(part)
    return docs.select(key, "text").join(F.broadcast(kept), key)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Coefficients, the constant first, of a weighted logistic regression by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6) * weight
        h = (x * w[:, None]).T @ x + ridge * np.eye(len(b))
        move = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * b)
        b += np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-8:
            break
    return b


def logistic(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(b[0] + x @ b[1:], -30, 30)))
