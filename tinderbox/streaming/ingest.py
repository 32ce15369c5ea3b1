"""Exactly-once ingestion of arriving feed files.

Plain files go through Spark's streaming file sink. Archives go through `foreachBatch`: the stream carries their names, and
a micro-batch reads each archive once, from which it replaces its own part of the table and of a ledger of files.
Both parts are keyed by the batch, so a batch that was cut off anywhere and runs again leaves what one run leaves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.schemas import FeedSpec
from tinderbox.session import staged
from tinderbox.sinks import storage, writers
from tinderbox.sources import archives
from tinderbox.sources.delimited import parse_lines


def stream_feed(spark: SparkSession, folder: str, spec: FeedSpec, files_per_batch: int = 1000) -> DataFrame:
    """Stream of typed rows from plain delimited files."""
    return (
        spark.readStream.schema(spec.schema)
        .option("sep", "\t")
        .option("header", spec.header)
        .option("mode", "PERMISSIVE")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def stream_archives(
    spark: SparkSession, folder: str, spec: FeedSpec, files_per_batch: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """Streams of typed rows and of (path, error) rows from zipped files.

    A damaged archive gives an error row and no rows at all. The two streams keep checkpoints of their own; store
    both, so that files which a checkpoint counts as read but that gave nothing can be delivered again
    under another name.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.zip")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    lines = archives.unpack(files, spec.header)
    rows = parse_lines(lines.where("error IS NULL").select("value"), spec.schema)
    return rows, lines.where("error IS NOT NULL").select("path", "error")


def ingest_available(rows: DataFrame, dest: str, checkpoint: str, part: str | None = None) -> None:
    """Read every file that has arrived and not been read, then stop.

    The checkpoint remembers the files and the Parquet sink commits each batch once, so a
    lost executor or a restarted job neither skips nor repeats one.
    """
    writer = rows.writeStream.format("parquet")
    query = (
        (writer.partitionBy(part) if part else writer)
        .option("path", dest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


BATCH = "ingest_batch"
REPAIR = "-repair"


@dataclass(frozen=True)
class Landing:
    """A feed's folder, the table its archives land in, and what is known about them.

    The table is partitioned by batch, then by the feed's day. The ledger has a row for each archive that was read: filename, lines,
    error (null if it was sound) and batch.
    """

    folder: str
    spec: FeedSpec
    table: str
    ledger: str
    checkpoint: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.table).drop(BATCH)

    def files(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.ledger)

    def damaged(self, spark: SparkSession) -> DataFrame:
        """(ingest_batch, filename, error) of archives of which no sound copy has been read yet."""
        if not storage.exists(spark, self.ledger):
            return spark.createDataFrame([], f"{BATCH} string, filename string, error string")
        files = self.files(spark)
        sound = files.where("error IS NULL").select("filename")
        return files.where("error IS NOT NULL").join(sound, "filename", "left_anti").select(BATCH, "filename", "error")


def _land(spark: SparkSession, to: Landing, names: list[str], key: str, sound_only: bool = False) -> int:
    """Read the named archives once; replace what batch `key` has in the table and in the ledger. Returns how many were sound."""
    lines = archives.archive_lines(spark, to.folder, to.spec).where(F.col("filename").isin(names))
    with staged(archives.typed_rows(lines, to.spec), "batch") as read:
        ends = read.where("NOT value_read").select("filename", F.col("line").alias("lines"), "error")
        sound = ends.where("error IS NULL").count()
        if sound_only and not sound:
            return 0
        rows = read.where("value_read").drop("value_read", "error")
        writers.replace_batch(rows, to.table, BATCH, key, to.spec.partition, ("filename", "line"))
        # Last: a batch counts as landed only when the ledger names its files.
        kept = ends.where("error IS NULL") if sound_only else ends
        kept.write.mode("overwrite").parquet(f"{to.ledger}/{BATCH}={key}")
    return sound


def land_archives(spark: SparkSession, to: Landing, files_per_batch: int = 1000, after: Callable[[str], None] | None = None) -> None:
    """Land every archive that has arrived and not been read, then stop.

    The checkpoint remembers names; the driver gathers those of one micro-batch, at most `files_per_batch`. A damaged archive
    gives a row of the ledger and no rows of the table. `after` is called with each batch's key when it has landed.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", f"*.{to.spec.file_suffix}.{{CSV,csv}}*.zip")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(to.folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("filename"))  # contents are not read
    )

    def land(batch: DataFrame, number: int) -> None:
        key = f"b{number:010d}"
        _land(batch.sparkSession, to, sorted(r[0] for r in batch.collect()), key)
        if after is not None:
            after(key)

    query = names.writeStream.foreachBatch(land).option("checkpointLocation", to.checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def repair_archives(spark: SparkSession, to: Landing) -> int:
    """Read archives again that were damaged; returns how many are sound now.

    The stream does not see a name twice, so a sound copy under the old name is found here. What is repaired of a batch has a
    part of its own, which is always written from all archives of the batch that were damaged at first; repeating
    a repair changes nothing.
    """
    waiting = to.damaged(spark)
    batches = sorted(r[0] for r in waiting.select(BATCH).distinct().collect())
    before = waiting.count()
    for key in batches:
        first = to.files(spark).where((F.col(BATCH) == key) & F.col("error").isNotNull())
        names = sorted(r[0] for r in first.select("filename").distinct().collect())
        _land(spark, to, names, key + REPAIR, sound_only=True)
    return before - to.damaged(spark).count()
