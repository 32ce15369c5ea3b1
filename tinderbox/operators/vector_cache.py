"""Caches of reduced text vectors that grow with the texts.

Each distinct text is encoded once per encoder. Its full vector is kept, the moments of all full vectors are kept up to date
by merging those of the new ones, and the components follow from them. When the components have moved,
the stored vectors are projected again; nothing is encoded again.

Layout below `root`, V being the number of a refresh: full/version=V (the texts it added), moments/version=V (of all texts
so far) and reduced/snapshot=V, whose completion makes the refresh count. What an interrupted refresh left is
overwritten by the next one.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.operators.embedding import Encoder, embed
from tinderbox.operators.moments import Components, components_of, merge_moments, moments, project
from tinderbox.sinks import storage, writers


def _root(root: str, encoder_name: str) -> str:
    """Vectors of different encoders never mix."""
    return f"{root}/encoder={quote(encoder_name, safe='')}"


def _version(spark: SparkSession, at: str) -> int:
    return max(writers.committed_snapshots(spark, f"{at}/reduced"), default=0)


def cached(spark: SparkSession, root: str, encoder_name: str) -> DataFrame | None:
    """(text, vector) as reduced by the last refresh."""
    return writers.latest_snapshot(spark, f"{_root(root, encoder_name)}/reduced")


def _full(spark: SparkSession, at: str, version: int) -> DataFrame:
    paths = [f"{at}/full/version={v}" for v in storage.partition_values(spark, f"{at}/full", "version") if int(v) <= version]
    return spark.read.parquet(*paths)


def model_of(spark: SparkSession, root: str, encoder_name: str, k: int) -> Components | None:
    """The components that the cached vectors were reduced with, for texts that are not to be cached."""
    at = _root(root, encoder_name)
    version = _version(spark, at)
    return components_of(spark.read.parquet(f"{at}/moments/version={version}"), k) if version else None


def refresh(df: DataFrame, root: str, text: str, encoder: Encoder, encoder_name: str, k: int, prefix: str = "") -> DataFrame:
    """Bring the cache up to the texts of `df` and return it: (text, vector), one row per text ever cached.

    Only texts not cached for this encoder are encoded, with `prefix` before them. Null texts are left out. `k` and
    `prefix` belong to the cache: a cache is refreshed with those it was made with. Without new texts nothing is written. The
    result is that of a cache built from all its texts at once, up to rounding.
    """
    spark, at = df.sparkSession, _root(root, encoder_name)
    version = _version(spark, at)
    fresh = df.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    if version:
        fresh = fresh.join(_full(spark, at, version).select("text"), "text", "left_anti")
    worded = fresh.withColumn("worded", F.concat(F.lit(prefix), F.col("text")))
    target = f"{at}/full/version={version + 1}"
    embed(worded, "worded", "vector", encoder).select("text", "vector").write.mode("overwrite").parquet(target)
    added = spark.read.parquet(target)
    if added.isEmpty():
        storage.delete(spark, target)
        return cached(spark, root, encoder_name) if version else spark.createDataFrame([], added.schema)
    sums = moments(added, "vector")
    if version:
        sums = merge_moments(spark.read.parquet(f"{at}/moments/version={version}").unionByName(sums))
    sums.coalesce(1).write.mode("overwrite").parquet(f"{at}/moments/version={version + 1}")
    model = components_of(spark.read.parquet(f"{at}/moments/version={version + 1}"), k)
    every = project(_full(spark, at, version + 1), "vector", model, "reduced").select("text", F.col("reduced").alias("vector"))
    every.write.mode("overwrite").parquet(f"{at}/reduced/snapshot={version + 1}")
    writers.keep_newest(spark, f"{at}/reduced")
    return cached(spark, root, encoder_name)
