"""A bounded, balanced sample of labelled rows, and the calibration of scores to probabilities."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import held_out


@dataclass(frozen=True)
class Sample:
    """Texts, their 0/1 labels, and how many labelled rows each class has in all."""

    texts: list[str]
    labels: np.ndarray
    class_rows: tuple[int, int]

    @property
    def weights(self) -> np.ndarray:
        """Each row's share of its class, so that weighted sums follow the true class sizes."""
        drawn = np.bincount(self.labels, minlength=2)
        return np.array([self.class_rows[y] / drawn[y] for y in self.labels])

    @property
    def usable(self) -> bool:
        return min(np.bincount(self.labels, minlength=2)) >= 2


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> Sample:
    """At most `per_class` documents of each class, the first by hash of the id, with texts up to
    `max_chars` long (both bounds hold for fitting only). Held-out rows, null labels, null ids and null
    texts take no part. A document labelled twice counts with its smaller label, and one that the
    table holds twice with its smaller text. Ids are drawn first, so only the drawn rows' texts move.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("y").alias("y"))
    )
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).where(F.length("text") <= max_chars)
    present = texts.select("id").distinct().join(known, "id").withColumn("draw", F.xxhash64("id"))
    drawn = reduce(
        DataFrame.unionByName, [present.where(F.col("y") == y).orderBy("draw", "id").limit(per_class) for y in (0, 1)]
    )
    # Broadcast: at most two times `per_class` ids.
    rows = texts.join(F.broadcast(drawn), "id").groupBy("draw", "id", "y").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["draw"], r["id"]))  # mixes the classes, the same way each time
    return Sample([r["text"] for r in rows], np.array([r["y"] for r in rows], int), (sizes.get(0, 0), sizes.get(1, 0)))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def platt(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is the probability of label 1: weighted logistic fit by
    Newton steps, with a small pull towards a = 1 and smoothed targets, so separable scores stay finite."""
    n1, n0 = weights[labels == 1].sum(), weights[labels == 0].sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = weights / weights.mean()
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * scores + b)
        gap, curve = w * (p - target), w * p * (1 - p) + 1e-9
        grad = np.array([gap @ scores + 1e-3 * (a - 1), gap.sum()])
        cross = curve @ scores
        hess = np.array([[curve @ scores**2 + 1e-3, cross], [cross, curve.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)
