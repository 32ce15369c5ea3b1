"""Principal components from sums that can be merged.

Count, sum and Gram matrix of vectors add up over any parts of them, so a model of all vectors follows from the stored
moments of the old ones and the moments of the new ones. A task adds up its own rows; what is shuffled
is one row per task and dimension. The driver sees the moments of all, whose size depends on the dimension alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOMENTS = "i int, n long, total double, gram array<double>"


def moments(df: DataFrame, vector: str) -> DataFrame:
    """One row per dimension i: how many vectors, the sum of their i-th components, and row i of the Gram matrix.

    Null vectors take no part; vectors that differ in length, or hold nulls, stop the job.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
            if np.isnan(rows).any():
                raise ValueError("a vector holds a null or NaN")
            if gram is None:
                total, gram = np.zeros(rows.shape[1]), np.zeros((rows.shape[1],) * 2)
            n, total = n + len(rows), total + rows.sum(axis=0)
            gram += rows.T @ rows
        if n:
            columns = [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total)), pa.array(total), pa.array(list(gram), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "total", "gram"])

    held = df.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("v"))
    return merge_moments(held.mapInArrow(add, MOMENTS))


def merge_moments(parts: DataFrame) -> DataFrame:
    """Sums over rows of the same dimension; union the moments of disjoint sets of vectors first."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = {len(g) for g in pdf["gram"]}
        if len(lengths) > 1:
            raise ValueError(f"vectors differ in length: {sorted(lengths)}")
        return pd.DataFrame({"i": [pdf["i"].iloc[0]], "n": [pdf["n"].sum()], "total": [pdf["total"].sum()], "gram": [np.sum(np.stack(pdf["gram"].to_numpy()), axis=0)]})

    return parts.groupBy("i").applyInPandas(add, MOMENTS)


@dataclass(frozen=True)
class Components:
    """Mean, components (rows, largest variance first) and the variances along all directions, in falling order."""

    mean: np.ndarray
    components: np.ndarray
    variances: np.ndarray

    @property
    def kept(self) -> np.ndarray:
        """Running share of the variance that the components keep."""
        whole = self.variances.sum()
        return np.cumsum(self.variances[: len(self.components)]) / (whole if whole else 1.0)


def components_of(sums: DataFrame, k: int) -> Components:
    """Components of the covariance (over n, not n - 1). Each one's sign makes its largest coordinate positive, the
    first of equally large ones, so equal moments give equal models. At most as many as there are dimensions."""
    rows = sorted(sums.collect())  # one row per dimension
    if not rows:
        return Components(np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    n = rows[0]["n"]
    mean = np.array([r["total"] for r in rows]) / n
    covariance = np.array([r["gram"] for r in rows]) / n - np.outer(mean, mean)
    variances, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    variances, vectors = np.maximum(variances[::-1], 0.0), vectors[:, ::-1].T
    top = vectors[:k]
    size = np.abs(top).round(12)
    lead = top[np.arange(len(top)), size.argmax(axis=1)]
    return Components(mean, top * np.where(lead < 0, -1.0, 1.0)[:, None], variances)


def project(df: DataFrame, vector: str, model: Components, out: str, kind: str = "float") -> DataFrame:
    """Add the reduced vector: the centred one along each component. Null vectors stay null."""
    mean, turned = model.mean, model.components.T

    @F.pandas_udf(f"array<{kind}>")
    def reduce(vectors: pd.Series) -> pd.Series:
        there = vectors.notna()
        done = iter((np.stack(vectors[there].to_numpy()).astype(np.float64) - mean) @ turned if there.any() else ())
        return pd.Series([next(done) if t else None for t in there], dtype=object)

    return df.withColumn(out, reduce(F.col(vector)))
