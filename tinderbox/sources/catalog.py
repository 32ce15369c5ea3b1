"""Catalog of feed files: listing, freshness, resolution of dates, incremental work."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.operators.joins import not_yet_done
from tinderbox.operators.windows import in_int_window
from tinderbox.schemas import FEEDS

# Suffix of a listed file.
LISTED_SUFFIX = {
    "events": "export.CSV.zip", "gkg": "gkg.csv.zip", "gkgcounts": "gkgcounts.csv.zip",
}
MAX_AGE = timedelta(hours=3)


def parse_listing(lines: DataFrame, source: str, base_url: str, value: str = "value") -> DataFrame:
    """File entries of an index page given as one line per row; other lines are skipped.

    An entry is a list item that links to a file and then states, in two pairs of parentheses, its
    size in MB and its MD5 checksum. Its date is what stands before the file's suffix.
    """
    shown = F.trim(F.regexp_replace(F.col(value), "<[^>]*>", ""))
    cells = F.transform(F.split(shown, r"\("), lambda c: F.trim(F.split_part(c, F.lit(")"), F.lit(1))))
    name, size, check = (F.get(cells, F.lit(i)) for i in range(3))
    stamp = F.regexp_replace(name, r"\." + LISTED_SUFFIX[source].replace(".", r"\.") + "$", "")
    megabytes = F.regexp_replace(size, "MB$", "")
    digest = F.trim(F.regexp_replace(check, "^MD5:", ""))
    href = F.regexp_extract(F.col(value), '(?i)href="([^"]*)"', 1)
    is_entry = (
        F.lower(F.ltrim(F.col(value))).startswith("<li>")
        & stamp.try_cast("decimal(38,0)").isNotNull()
        & size.endswith("MB") & megabytes.try_cast("double").isNotNull()
        & check.startswith("MD5:") & digest.rlike("^[0-9a-f]+$")
    )
    return lines.where(is_entry).select(
        stamp.alias("date_str"),
        href.alias("filename"),
        megabytes.alias("size_mb"),
        digest.alias("md5"),
        F.concat(F.lit(base_url + "/"), href).alias("full_url"),
        F.lit(source).alias("event_type"),
    )


def cached_catalog(
    spark: SparkSession, path: str, load, now: datetime | None = None, refresh: bool = False
) -> DataFrame:
    """Stored catalog while younger than three hours, else `load()` stored anew."""
    now = now or datetime.now(tz=timezone.utc)
    if not refresh:
        try:
            stored = spark.read.parquet(path)
            fetched = stored.agg(F.max("fetched_at")).first()[0]
        except Exception as err:  # no catalog stored so far
            if "PATH_NOT_FOUND" not in str(err):
                raise
            fetched = None
        if fetched is not None and now - fetched.replace(tzinfo=timezone.utc) < MAX_AGE:
            return stored.drop("fetched_at")
    stamp = F.lit(now.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    load().withColumn("fetched_at", stamp).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).drop("fetched_at")


def resolve_files(stamps: DataFrame, catalog: DataFrame) -> DataFrame:
    """File of each wanted date; `is_missing` marks dates the catalog lacks."""
    return stamps.join(catalog.select("date_str", "full_url"), "date_str", "left").withColumn(
        "is_missing", F.col("full_url").isNull()
    )


def require_all(resolved: DataFrame) -> DataFrame:
    """Raise at run time if a wanted date has no file."""
    message = F.concat(F.lit("no file for "), F.col("date_str"))
    url = F.when(F.col("is_missing"), F.raise_error(message)).otherwise(F.col("full_url"))
    return resolved.select("date_str", url.alias("full_url"))


def new_files(
    catalog: DataFrame, checkpoint: DataFrame, source: str, start: date, end: date,
    force: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(files to read, files to record): all of the window if forced, else the unread ones."""
    if source not in FEEDS:
        raise ValueError(f"unknown source {source!r}")
    listed = catalog.where(F.col("event_type") == source).withColumn(
        "__day", F.col("date_str").try_cast("int")
    )
    wanted = in_int_window(listed, "__day", start, end).drop("__day")
    unread = not_yet_done(wanted, checkpoint, ["date_str", "event_type"])
    return (wanted if force else unread), unread


def verify_md5(files: DataFrame, catalog: DataFrame, name: str = "filename") -> DataFrame:
    """Mark files (filename, content) whose checksum equals the listed one."""
    listed = catalog.select(name, F.col("md5").alias("listed_md5"))
    return files.join(listed, name, "left").withColumn(
        "is_intact", F.md5("content") == F.col("listed_md5")
    )
