"""Gold tables: heat per event and place, aggregates, rollups, forecasts, top news."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.functions import geo, heat, scalars, text
from tinderbox.operators import aggregates as A
from tinderbox.operators import series as S
from tinderbox.operators.enrich import describe_all
from tinderbox.operators.medians import exact_medians, value_counts
from tinderbox.operators.frequency import running_total
from tinderbox.operators.windows import require_distinct_columns
from tinderbox.plans import silver

# Root codes of threats, protests, assaults and mass violence.
CONFLICT_ROOTS = ["13", "14", "18", "20"]

HEAT_NAMES = {
    "action_geo_country_code": "country_code",
    "action_geo_country": "country",
    "action_geo_state": "state",
    "action_geo_lat": "lat",
    "action_geo_lon": "lon",
    "ev_date": "indicator_date",
}
_HEAT_INPUT = """
    date_added ev_id ev_date action_geo_country_code action_geo_country action_geo_state
    action_geo_lat action_geo_lon is_root_event gstein_scale avg_tone num_sources num_articles
    num_mentions source_url quad_class quad_class_desc ev_root_code ev_root_desc ev_base_code
    ev_code ev_desc
""".split()


def heat_columns(
    events: DataFrame, divided: list[str] = geo.HEAT_ZONE_COUNTRIES
) -> DataFrame:
    """Keep hot events of known countries and add heat and zone (columns in heat vocabulary)."""
    score = heat.squared(F.col("gstein_scale"))
    zone = geo.zone_label(F.col("country_code"), F.col("country"), F.col("state"), divided)
    return (
        events.where(scalars.filled(F.col("country_code")) & (score > 0))
        .withColumn("heat_indicator", score)
        .withColumn("geo_zone", zone)
    )


def heat_by_event(silver: DataFrame) -> DataFrame:
    """Silver events -> one row per hot event."""
    named = silver.select(*_HEAT_INPUT).withColumnsRenamed(HEAT_NAMES)
    return require_distinct_columns(heat_columns(named))


def heat_by_location(heat_events: DataFrame) -> DataFrame:
    keys = ["indicator_date", "country_code", "country", "geo_zone"]
    return A.location_heat(heat_events, keys)


def root_event_heat(enriched: DataFrame) -> DataFrame:
    """Root events with log-mention heat (any sign)."""
    return enriched.where("is_root_event = 1").select(
        F.col("ev_date").alias("heat_date"),
        "ev_id",
        F.col("action_geo_country_code").alias("country_code"),
        "geo_zone",
        "quad_class_desc",
        "ev_root_desc",
        "ev_desc",
        heat.mention_weighted(F.col("gstein_scale"), F.col("num_mentions")).alias("ev_heat"),
        F.col("action_geo_lat").alias("lat"),
        F.col("action_geo_lon").alias("lon"),
        "source_url",
        "quad_class",
        "ev_root_code",
        "ev_base_code",
        "ev_code",
    )


WEIGHTS = {"mentions": "num_mentions", "sources": "num_sources", "articles": "num_articles"}


def _country_aggregate(enriched: DataFrame, day: str, code: str, desc: str) -> DataFrame:
    named = enriched.withColumnsRenamed(
        {"action_geo_country_code": "action_country_code", "action_geo_country": "action_country"}
    )
    keys = [day, "action_country_code", "action_country", code, desc]
    return A.weighted_scores(named, keys, "gstein_scale", WEIGHTS)


def country_quad_class(enriched: DataFrame) -> DataFrame:
    return _country_aggregate(enriched, "ev_date", "quad_class", "quad_class_desc")


def country_ev_root(enriched: DataFrame) -> DataFrame:
    return _country_aggregate(enriched, "date_added", "ev_root_code", "ev_root_desc")


def country_ev_base(enriched: DataFrame) -> DataFrame:
    return _country_aggregate(enriched, "ev_date", "ev_base_code", "ev_base_desc")


def geo_locations(enriched: DataFrame) -> DataFrame:
    return A.place_rollup(
        enriched, ["country", "state", "city"], "action_geo_lat", "action_geo_lon"
    ).withColumnsRenamed({"action_geo_lat": "lat", "action_geo_lon": "lon"})


def geo_zones(enriched: DataFrame) -> DataFrame:
    """Zones per country code; the name shown is the dictionary's, the filter the place's."""
    slim = enriched.where(F.col("country").isNotNull()).select(
        F.col("action_geo_country_code").alias("country_code"),
        F.col("action_geo_country").alias("country"),
        "geo_zone",
        F.col("action_geo_lat").alias("lat"),
        F.col("action_geo_lon").alias("lon"),
    )
    known = slim.withColumn("country", F.coalesce("country", F.lit("")))
    zones = A.zone_table(known, "country_code", "country", "geo_zone", "lat", "lon")
    return zones.withColumn("country", scalars.blank_to_null(F.col("country")))


def place_values(bronze: DataFrame, day: str) -> DataFrame:
    """How often each position occurs per day and place: what both place tables are made of, without descriptions."""
    placed = silver.placed_events(bronze).withColumn("part_day", F.col(day).cast("string"))
    placed = placed.withColumnsRenamed({"action_geo_country_code": "country_code", "action_geo_lat": "lat", "action_geo_lon": "lon"})
    usable = placed.where(F.col("country").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return value_counts(usable, ["part_day", "country", "state", "city", "country_code"], ["lat", "lon"])


def locations_of(values: DataFrame) -> DataFrame:
    """`geo_locations` from folded place values."""
    return A.rollup_of_counts(values, ["country", "state", "city"], "lat", "lon")


def zones_of(values: DataFrame, fips_country: DataFrame) -> DataFrame:
    """`geo_zones` from folded place values; names are those of the present dictionary."""
    zone = geo.zone_path(F.col("country_code"), F.col("country"), F.col("state"))
    zoned = values.withColumn("geo_zone", zone).where("geo_zone IS NOT NULL AND country_code IS NOT NULL").drop("country")
    fine = zoned.groupBy("country_code", "geo_zone", "measure", "value").agg(F.sum("n").alias("n"))
    named = describe_all(fine, [(fips_country, "country_code", "fips_country_code", "country_name", "country")])
    return A.zones_of_counts(named, "country_code", "country", "geo_zone", "lat", "lon")


def country_forecast(
    location_heat: DataFrame, end: date, horizon: int = 7, months: int = 3
) -> DataFrame:
    """Forecast of each country's mean daily heat, days without events counting as 0."""
    recent = S.recent_months(location_heat, "indicator_date", end, months)
    series = S.mean_series(recent, "indicator_date", ["country_code", "country"], "heat_indicator")
    predicted = S.additive_forecast(
        series, ["country_code", "country"], "indicator_date", "heat_indicator", horizon
    )
    return predicted.withColumnRenamed("ds", "indicator_date").withColumn(
        "date_predicted", F.lit(end)
    )


def zone_series(
    silver: DataFrame, roots: list[str] = CONFLICT_ROOTS, since: date | None = None
) -> tuple[DataFrame, DataFrame]:
    """(dense daily heat per zone and country, positions of zones) from conflict events."""
    zone = geo.zone_state(
        F.col("action_geo_country_code"), F.col("action_geo_country"), F.col("action_geo_state")
    )
    blended = heat.tone_blend(F.col("gstein_scale"), F.col("avg_tone"), F.col("num_mentions"))
    hot = (
        silver.where(F.col("ev_root_code").isin(roots))
        .select(
            "ev_date",
            zone.alias("geo_zone"),
            F.col("action_geo_country").alias("country"),
            blended.alias("heat"),
            F.col("action_geo_lat").alias("lat"),
            F.col("action_geo_lon").alias("lon"),
        )
        .where(F.col("geo_zone").isNotNull())
    )
    keys = ["ev_date", "geo_zone", "country"]
    # Means and positions stay apart: the grid reads only the former, which are cheap.
    means = A.zone_means(hot, keys, "heat")
    centroids = A.zone_centroid(exact_medians(hot, keys, ["lat", "lon"]), ["geo_zone"], "lat", "lon")
    grid = S.dense_grid(
        means, "ev_date", ["geo_zone", "country"], ["heat_indicator", "frequency"], since
    )
    return grid.withColumnRenamed("ev_date", "indicator_date"), centroids


def zone_forecast(
    dense: DataFrame, centroids: DataFrame, horizon: int = 1, freq: str = "W",
    forecaster: S.Forecaster | None = None,
) -> DataFrame:
    """Forecast per zone and country with the zone's position.

    The built-in model runs in Spark's own functions, another `forecaster` per key in Python.
    """
    how = (dense, ["geo_zone", "country"], "indicator_date", "heat_indicator", horizon, freq)
    predicted = S.additive_forecast(*how) if forecaster is None else S.forecast_groups(*how, forecaster)
    return S.with_attributes(predicted, centroids, ["geo_zone"])


def event_sentences(silver: DataFrame) -> DataFrame:
    """Described events, ready for embedding."""
    place = text.place_path(
        F.col("action_geo_country"), F.col("action_geo_state"), F.col("action_geo_location")
    )
    sentence = text.event_sentence(
        F.col("a1_name"), F.col("a1_type1_desc"), F.col("ev_root_desc"), F.col("ev_desc"),
        F.col("a2_name"), F.col("a2_type1_desc"), place, F.col("source_url"),
    )
    return silver.select("date_added", "ev_id", "ev_date", sentence.alias("svp_description"))


def event_descriptions(enriched: DataFrame) -> DataFrame:
    """Distinct quad / root / event descriptions with log counts and their full text."""
    keys = ["quad_class_desc", "ev_root_desc", "ev_desc"]
    full = text.full_description(*[F.col(k) for k in keys])
    return A.log_counts(enriched, keys).withColumn("full_desc", full)


# How a name is worded for encoding, and its reduced size.
COUNTRY_CACHE = {"prefix": "This event happened in the country of ", "k": 30}
EVENT_CACHE = {"prefix": "Actor 1 did the following to Actor 2: ", "k": 40}
PLACE_CACHE = {"prefix": "This event happened in: ", "k": 100}


def country_names(enriched: DataFrame) -> DataFrame:
    return A.log_counts(enriched.withColumn("country", F.col("action_geo_country")), ["country"])


def place_names(enriched: DataFrame) -> DataFrame:
    """All place names, most frequent first, with their share and running share of all events."""
    named = enriched.withColumn("geo_full_name", F.col("action_geo_full_name"))
    return _place_shares(A.log_counts(named, ["geo_full_name"]))


def _place_shares(log_counts: DataFrame) -> DataFrame:
    counts = A.share_of_total(log_counts)
    # A key without nulls: events without a place count too, and the running share ends at 1.
    key = F.coalesce(F.concat(F.lit("="), "geo_full_name"), F.lit("null"))
    ranked = running_total(counts.withColumn("__key", key), "__key")
    total = counts.agg(F.sum("cnt")).scalar()
    return ranked.select(*counts.columns, (F.col("cum_cnt") / total).alias("fraction_cumsum"))


# What the named tables count, by the raw codes of an event; descriptions are looked up when a table is made.
NAME_KEYS = {
    "country": ["action_geo_country_code"],
    "event": ["quad_class", "ev_root_code", "ev_code"],
    "place": ["action_geo_full_name"],
}


def name_parts(bronze: DataFrame, day: str, kind: str) -> DataFrame:
    """How often each combination of codes occurs per day."""
    dated = bronze.withColumn("part_day", F.col(day).cast("string"))
    return dated.groupBy("part_day", *NAME_KEYS[kind]).agg(F.count(F.lit(1)).alias("n"))


def names_of(kind: str, counts: DataFrame, d: silver.Dictionaries) -> DataFrame:
    """`country_names`, `event_descriptions` or `place_names` from folded counts."""
    if kind == "place":
        return _place_shares(A.log_sums(counts.withColumnRenamed("action_geo_full_name", "geo_full_name"), ["geo_full_name"]))
    if kind == "country":
        named = describe_all(counts, [(d.fips_country, "action_geo_country_code", "fips_country_code", "country_name", "country")])
        return A.log_sums(named, ["country"])
    keys = ["quad_class_desc", "ev_root_desc", "ev_desc"]
    named = describe_all(
        counts,
        [
            (d.quad_classes, "quad_class", "quad_class", "ev_desc", "quad_class_desc"),
            (d.cameo_event, "ev_root_code", "ev_code", "ev_desc", "ev_root_desc"),
            (d.cameo_event, "ev_code", "ev_code", "ev_desc", "ev_desc"),
        ],
    )
    return A.log_sums(named, keys).withColumn("full_desc", text.full_description(*[F.col(k) for k in keys]))
