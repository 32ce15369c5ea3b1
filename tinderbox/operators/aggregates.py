"""Grouped indicators, rollups and diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.operators.joins import join_null_safe
from tinderbox.operators.medians import exact_medians, medians_of_counts, value_counts


def weighted_scores(
    df: DataFrame, keys: list[str], score: str, weights: dict[str, str]
) -> DataFrame:
    """Count, plain mean and weighted means of a score.

    The denominators include rows whose score is NULL, so this is not `avg`.
    `weights` maps an output suffix to its weight column.
    """
    g = F.col(score).cast("double")
    means = [
        F.try_divide(F.sum(g * F.col(w)), F.sum(w)).alias(f"avg_gstein_weighted_{suffix}")
        for suffix, w in weights.items()
    ]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.try_divide(F.sum(g), F.count(F.lit(1))).alias("avg_gstein"),
        *means,
    )


def location_heat(
    df: DataFrame, keys: list[str], heat: str = "heat_indicator", mentions: str = "num_mentions"
) -> DataFrame:
    """Event count and log-mention-weighted heat per place and day."""
    weight = F.log1p(F.col(mentions))
    return df.groupBy(*keys).agg(
        F.count("ev_id").alias("frequency"),
        F.try_divide(F.sum(weight * F.col(heat)), F.sum(weight)).alias("heat_indicator"),
    )


def place_rollup(df: DataFrame, levels: list[str], lat: str, lon: str) -> DataFrame:
    """Event count and median position per prefix of `levels`, coarsest level never NULL.

    `grouping_id` tells a subtotal from a row whose finer level is really NULL;
    `geo_granularity` counts the non-NULL levels.
    """
    placed = df.where(
        F.col(levels[0]).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()
    )
    return rollup_of_counts(value_counts(placed, levels, [lat, lon]), levels, lat, lon)


def rollup_of_counts(fine: DataFrame, levels: list[str], lat: str, lon: str) -> DataFrame:
    """`place_rollup` from value counts at the finest level, such as folded ones.

    Equal positions are counted once at the finest level, then those counts are rolled up.
    """
    prefixes = [levels[:n] for n in range(len(levels), 0, -1)]
    rows = F.array(
        *[
            F.struct(
                *[(F.col(c) if c in p else F.lit(None).cast("string")).alias(c) for c in levels],
                F.lit(2 ** (len(levels) - len(p)) - 1).cast("bigint").alias("grouping_id"),
            )
            for p in prefixes
        ]
    )
    spread = fine.select(F.explode(rows).alias("r"), "measure", "value", "n")
    keys = [*levels, "grouping_id"]
    counts = (
        spread.select("r.*", "measure", "value", "n")
        .groupBy(*keys, "measure", "value")
        .agg(F.sum("n").alias("n"))
    )
    depth = sum((F.col(c).isNotNull().cast("int") for c in levels[1:]), F.lit(1))
    return _counted(counts, keys, lat, lon).withColumn("geo_granularity", depth)


def _counted(counts: DataFrame, keys: list[str], lat: str, lon: str, extra=()) -> DataFrame:
    """Medians and event counts from the same value counts: every row has both positions.

    The sum is conditional, not filtered, so that both branches share one shuffle.
    """
    events = F.sum(F.when(F.col("measure") == lat, F.col("n")))
    totals = counts.groupBy(*keys).agg(events.alias("ev_count"), *extra)
    return join_null_safe(totals, medians_of_counts(counts, keys, [lat, lon]), keys, "left")


def zone_table(
    df: DataFrame, code: str, country: str, zone: str, lat: str, lon: str
) -> DataFrame:
    """Name, median position and event count per zone."""
    usable = df.where(
        F.col(lat).isNotNull()
        & F.col(lon).isNotNull()
        & F.col(country).isNotNull()
        & F.col(zone).isNotNull()
    )
    return zones_of_counts(value_counts(usable, [code, zone, country], [lat, lon]), code, country, zone, lat, lon)


def zones_of_counts(fine: DataFrame, code: str, country: str, zone: str, lat: str, lon: str) -> DataFrame:
    """`zone_table` from value counts by code, zone and country (or finer)."""
    keys = [code, zone]
    counts = fine.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"), F.max(country).alias(country))
    return _counted(counts, keys, lat, lon, [F.max(country).alias("country")])


def zone_means(df: DataFrame, keys: list[str], heat: str) -> DataFrame:
    """Mean heat and event count per zone and day."""
    return df.groupBy(*keys).agg(
        F.avg(heat).alias("heat_indicator"), F.count(F.lit(1)).alias("frequency")
    )


def zone_day(df: DataFrame, keys: list[str], heat: str, lat: str, lon: str) -> DataFrame:
    """`zone_means` with the median position."""
    middle = exact_medians(df, keys, [lat, lon])
    return join_null_safe(zone_means(df, keys, heat), middle, keys, "left")


def zone_centroid(daily: DataFrame, keys: list[str], lat: str, lon: str) -> DataFrame:
    """Median of daily medians. A group has one row per day, so `median` stays small."""
    return daily.groupBy(*keys).agg(F.median(lat).alias(lat), F.median(lon).alias(lon))


def log_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"), F.log1p(F.count(F.lit(1))).alias("log_1p_cnt")
    )


def log_sums(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """`log_counts` from counts by finer keys, such as folded ones."""
    return counts.groupBy(*keys).agg(F.sum(n).alias("cnt"), F.log1p(F.sum(n)).alias("log_1p_cnt"))


def share_of_total(counts: DataFrame, count: str = "cnt", share: str = "fraction") -> DataFrame:
    """Each count divided by their sum; the sum is a scalar subquery."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.col(count) / total)


def partition_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))
