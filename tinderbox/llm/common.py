"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.session import new_dir

# A word is a run of characters other than the space and the controls 9 to 13. These are the
# bytes at which `bytes.split()` cuts, so UTF-8 bytes split natively give exactly these words.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it back: lineage ends here, and a lost
    executor costs only a second read."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds at most `max_bytes`, or a single row."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, min(rows, rows * max_bytes // max(batch.get_total_buffer_size(), 1)))
        at = 0
        while at < rows:
            piece = batch.slice(at, step)
            while piece.num_rows > 1 and piece.nbytes > max_bytes:
                piece = piece.slice(0, piece.num_rows // 2)
            yield piece
            at += piece.num_rows


def by_position(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """`mapInArrow` to the same columns, under plain names while it runs: a name may hold dots."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def held_out(doc_id) -> F.Column:
    """Rows no model may learn from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
