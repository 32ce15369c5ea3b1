"""Unions of frames with matching columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_same(frames: list[DataFrame]) -> DataFrame:
    """Union by name; every frame must have exactly the columns of the first."""
    if not frames:
        raise ValueError("nothing to union")
    want = sorted(frames[0].columns)
    for i, df in enumerate(frames):
        if sorted(df.columns) != want:
            raise ValueError(f"frame {i} has columns {df.columns}, expected {frames[0].columns}")
    return reduce(DataFrame.unionByName, frames)
