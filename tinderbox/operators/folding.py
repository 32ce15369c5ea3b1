"""Totals kept up to date from per-day parts.

A folded table holds counts by key. What each day adds is stored as that day's part; a refresh computes the parts of the
touched days only, takes their former parts out of the totals and puts the new ones in. Totals grow with the
distinct keys, not with the days, and a day may be refreshed any number of times.

Layout below `root`: parts/version=V/part_day=D, days/version=V (the days that version V touched) and
totals/snapshot=V. A version exists once its totals are committed; what an interrupted refresh left under the same number is
overwritten by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tinderbox.sinks import storage, writers

DAY = "part_day"


def _committed(spark: SparkSession, root: str) -> int:
    return max(writers.committed_snapshots(spark, f"{root}/totals"), default=0)


def totals(spark: SparkSession, root: str) -> DataFrame | None:
    """The folded counts, or None before the first refresh."""
    done = _committed(spark, root)
    return spark.read.parquet(f"{root}/totals/snapshot={done}") if done else None


def part_versions(spark: SparkSession, root: str) -> dict[str, int]:
    """The version that holds each day's present part; days, not rows, pass the driver."""
    done = _committed(spark, root)
    if not done:
        return {}
    days = spark.read.parquet(f"{root}/days").where(F.col("version") <= done)
    return {r[0]: r[1] for r in days.groupBy("day").agg(F.max("version")).collect()}


def known_days(spark: SparkSession, root: str, low: str, high: str) -> list[str]:
    """Days in [low, high] that have a part, an empty one included."""
    return sorted(d for d in part_versions(spark, root) if low <= d <= high)


def fold(spark: SparkSession, root: str, parts: DataFrame, days: list[str], measures: list[str]) -> DataFrame:
    """Replace the parts of `days` and return the totals.

    `parts` has the column `part_day`, key columns and numeric `measures`, one row per day and key; days not listed must not
    occur, listed ones without rows become empty. A key whose first measure falls to zero leaves the totals.
    Keys may be null. No days, no change.
    """
    done = _committed(spark, root)
    if not days:
        return totals(spark, root) if done else parts.drop(DAY).limit(0)
    version, known = done + 1, part_versions(spark, root)
    target, schema = f"{root}/parts/version={version}", parts.schema
    parts.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(target)
    spark.createDataFrame([(d,) for d in days], "day string").coalesce(1).write.mode("overwrite").parquet(f"{root}/days/version={version}")

    keys = [f.name for f in schema.fields if f.name not in (DAY, *measures)]
    plain = T.StructType([f for f in schema.fields if f.name != DAY])
    fresh = spark.read.schema(plain).parquet(target).select(plain.names)
    stale = [f"{root}/parts/version={known[d]}/{DAY}={d}" for d in days if d in known]
    stale = [p for p in stale if storage.exists(spark, p)]
    rows = fresh
    if stale:
        former = spark.read.schema(plain).parquet(*stale)
        rows = rows.unionByName(former.withColumns({m: -F.col(m) for m in measures}))
    if done:
        rows = rows.unionByName(totals(spark, root).select(plain.names))
    folded = rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]).where(F.col(measures[0]) != 0)
    folded.select(plain.names).write.mode("overwrite").parquet(f"{root}/totals/snapshot={version}")
    for path in stale:  # superseded, and no longer named by any version in use
        storage.delete(spark, path)
    writers.keep_newest(spark, f"{root}/totals")
    return totals(spark, root)
