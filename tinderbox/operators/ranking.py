"""Deterministic top-k and first-per-key selections.

Filters of the form `row_number() <= k` run as a grouped limit before the shuffle, so a hot
group sends at most k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tinderbox.functions.text import url_hash


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str
) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, position.cast("bigint")).where(F.col(rank) <= k)


def hottest_events(
    heat: DataFrame,
    k: int,
    day: str = "date_added",
    zone: str = "geo_zone",
    url: str = "source_url",
    score: str = "heat_indicator",
    tie: str = "ev_id",
) -> DataFrame:
    """The k hottest events per day and zone, each url counted once there."""
    order = [F.col(score).desc(), F.col(tie)]
    usable = heat.where(F.col(zone).isNotNull() & (F.col(zone) != ""))
    best = first_per_key(usable, [day, zone, url], order)
    return top_per_group(best, [day, zone], order, k, "heat_rank")


def hottest_urls(
    heat: DataFrame, k: int, url: str = "source_url", score: str = "heat_indicator",
    tie: str = "ev_id", **names: str,
) -> DataFrame:
    """`hottest_events` with each url kept once over all days and zones, plus its hash."""
    top = hottest_events(heat, k, url=url, score=score, tie=tie, **names)
    order = [F.col(score).desc(), F.col(tie)]
    return first_per_key(top, [url], order).withColumn("url_hash", url_hash(F.col(url)))


def url_wishlist(records: DataFrame, urls: str, order: list[Column]) -> DataFrame:
    """One row per distinct url of an array column; the last record in `order` wins."""
    exploded = records.withColumn("url", F.explode(F.array_distinct(urls)))
    hashed = exploded.drop(urls).withColumn("url_hash", url_hash(F.col("url")))
    return first_per_key(hashed, ["url_hash"], order)


def top_by_count(counts: DataFrame, key: str, n: int, count: str = "cnt") -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(key)).limit(n)
