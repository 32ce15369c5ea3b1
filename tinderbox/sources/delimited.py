"""Tolerant scans of tab-separated feed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tinderbox.schemas import FeedSpec, ddl


def scan(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    header: bool = False,
    sep: str = "\t",
) -> DataFrame:
    """Delimited files with a fixed schema.

    Unreadable numbers become NULL, short rows are padded, long rows are cut.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .csv(paths)
    )


def scan_feed(spark: SparkSession, paths: str | list[str], spec: FeedSpec) -> DataFrame:
    return scan(spark, paths, spec.schema, spec.header)


def parse_lines(
    lines: DataFrame, schema: T.StructType, value: str = "value", sep: str = "\t"
) -> DataFrame:
    """The same reading for lines that are already rows (unpacked archives, streams)."""
    row = F.from_csv(value, ddl(schema), {"sep": sep, "mode": "PERMISSIVE"})
    keep = [c for c in lines.columns if c != value]
    return lines.withColumn("__row", row).select(*keep, "__row.*")


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to a declared schema, unreadable cells as NULL."""
    return df.select(
        *[
            F.trim(F.col(f.name), F.lit('"')).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
