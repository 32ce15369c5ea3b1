"""Table scans by name or path."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.functions.scalars import extract_dates


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder when the name looks like a path."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def sample_files(
    spark: SparkSession, folder: str, suffix: str, start: date, end: date, fraction: float,
    seed: int = 0,
) -> DataFrame:
    """Sample of the Parquet files whose name holds a date inside [start, end].

    The condition stands on the file's name, so Spark drops whole files before it reads any; their names stay
    with Spark's own listing.
    """
    files = (
        spark.read.option("pathGlobFilter", f"*.{suffix}.*parquet").option("recursiveFileLookup", True).parquet(folder)
    )
    days = extract_dates(F.col("_metadata.file_name"))
    chosen = files.where(F.exists(days, lambda d: d.between(F.lit(start), F.lit(end))))
    if chosen.limit(1).isEmpty():
        raise FileNotFoundError(f"no {suffix} rows for {start}..{end} below {folder}")
    return chosen.sample(fraction=fraction, seed=seed)
