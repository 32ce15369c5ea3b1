"""Session defaults and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splitting a skewed join is worth an extra shuffle when one key holds a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Conditions on days and file names decide which archives are opened.
    "spark.sql.python.filterPushdown.enabled": "true",
}

_fallback: dict[str, str] = {}


def build(master: str | None = None, app: str = "tinderbox", **extra: str) -> SparkSession:
    """Create (or get) a session with the engine's settings; `extra` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# For writes of wide stored tables through many lookups: their fused method would exceed the
# 8000 bytes the JVM still compiles, and runs twice as fast operator by operator (measured).
WIDE_LOOKUPS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def scoped(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the actions inside the block only."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local master may fall back to a folder on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _fallback[app]


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`df` written once below the shared folder and read back for as often as the block needs it, then deleted.

    What is derived from it must be written before the block ends.
    """
    spark, path = df.sparkSession, new_dir(df.sparkSession, label)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
