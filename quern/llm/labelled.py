"""What the two classifiers share: a bounded sample of labelled rows, and calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, k: int) -> Column:
    """crc32 of the id as text, modulo k; null for a null id."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(k))


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: dict[int, int], id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most per_class[y] labelled ids of each class y, those with the smallest digests; and all labelled ids by class.

    ``train`` says which ids may be learned from. An id with several labels counts as 1. Of rows that share an id the smallest text is taken.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y")).where(train)
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("y = 0").orderBy(*order).limit(per_class[0]).union(known.where("y = 1").orderBy(*order).limit(per_class[1]))
    body = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    # chosen has sum(per_class) rows of two numbers at most, so the broadcast's size is fixed by that parameter.
    return body.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")), counts


def class_weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give the sample the class shares of all labelled rows; mean 1."""
    w = np.ones(len(y))
    for c in (0, 1):
        w[y == c] = counts.get(c, 0) / max(1, int((y == c).sum()))
    return w / w.mean() if len(w) and w.sum() else w


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Platt:
    """A logistic curve from raw scores to probabilities, fitted with softened targets."""

    def __init__(self, raw: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.a, self.b = 1.0, 0.0
        if len(set(y.tolist())) < 2:
            return
        x = logit(raw)
        up, down = weight[y == 1].sum(), weight[y == 0].sum()
        target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
        for _ in range(50):
            p = 1 / (1 + np.exp(-(self.a * x + self.b)))
            g, h = weight * (p - target), weight * p * (1 - p)
            grad = np.array([(g * x).sum() + 0.01 * (self.a - 1), g.sum()])
            hess = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
            step = np.linalg.solve(hess, grad)
            step /= max(1.0, np.abs(step).max())
            self.a, self.b = max(1e-3, self.a - step[0]), self.b - step[1]
            if np.abs(step).max() < 1e-6:
                break

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.a * logit(raw) + self.b)))
