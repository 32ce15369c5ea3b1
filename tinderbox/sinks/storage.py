"""Partition folders of Parquet tables, through Hadoop's file system API."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first-level partition folders (`column=value`)."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    return sorted(unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    delete(spark, f"{path}/{column}={value}")
