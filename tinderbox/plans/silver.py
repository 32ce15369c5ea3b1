"""Bronze -> silver: typed dates, place parts and descriptions for every code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox import schemas
from tinderbox.functions import feed_fields, geo, scalars
from tinderbox.operators.enrich import describe_all


@dataclass(frozen=True)
class Dictionaries:
    """The six code tables, each with unique codes."""

    fips_country: DataFrame
    cameo_event: DataFrame
    quad_classes: DataFrame
    cameo_actor_type: DataFrame
    geo_type: DataFrame
    cameo_country: DataFrame


def silver_events(bronze: DataFrame, d: Dictionaries) -> DataFrame:
    """Sixteen dictionary lookups, place parts and real dates; no shuffle of the events."""
    parts, places, lookups = {}, {}, []
    for who in ("a1", "a2", "action"):
        parts[f"{who}_parts"] = geo.name_parts(F.col(f"{who}_geo_full_name"))
        places[f"{who}_geo_location"] = geo.location_part(F.col(f"{who}_parts"))
        places[f"{who}_geo_state"] = geo.state_part(F.col(f"{who}_parts"))
        lookups += [
            (d.fips_country, f"{who}_geo_country_code", "fips_country_code", "country_name",
             f"{who}_geo_country"),
            (d.geo_type, f"{who}_geo_id", "geo_type", "geo_type_desc", f"{who}_geo_type"),
        ]
    for level in ("ev_root", "ev_base", "ev"):
        lookups.append((d.cameo_event, f"{level}_code", "ev_code", "ev_desc", f"{level}_desc"))
    lookups.append((d.quad_classes, "quad_class", "quad_class", "ev_desc", "quad_class_desc"))
    for who in ("a1", "a2"):
        for kind in ("type1", "type2"):
            lookups.append(
                (d.cameo_actor_type, f"{who}_{kind}_code", "a_type_code", "a_type_desc",
                 f"{who}_{kind}_desc")
            )
        lookups.append(
            (d.cameo_country, f"{who}_country_code", "cameo_country_code", "country_name",
             f"{who}_country_name")
        )
    dates = {c: scalars.int_date(F.col(c)) for c in ("ev_date", "date_added")}
    placed = bronze.withColumns(parts).withColumns({**places, **dates}).drop(*parts)
    named = describe_all(placed, lookups)
    return named.select(*schemas.SILVER_EVENTS_COLUMNS)


def silver_gkg(bronze: DataFrame) -> DataFrame:
    """Nested text fields as arrays and structs."""
    lists = {"themes": ";", "persons": ";", "organizations": ";", "event_ids": ",",
             "sources": ";", "source_urls": "<UDIV>"}
    parsed = {c: scalars.split_list(F.col(c), sep) for c, sep in lists.items()}
    parsed["counts"] = feed_fields.counts(F.col("counts"))
    parsed["locations"] = feed_fields.locations(F.col("locations"))
    parsed["tone_vec"] = feed_fields.tone(F.col("tone_vec"))
    return bronze.withColumns(parsed)


def flat_gkg(bronze: DataFrame) -> DataFrame:
    """The file-based variant: dates, id arrays with -1 for bad ids, tone in six columns."""
    lists = {"themes": ";", "persons": ";", "organizations": ";", "sources": ";",
             "source_urls": "<UDIV>"}
    return bronze.select(
        scalars.int_date(F.col("pub_date")).alias("pub_date"),
        "num_articles",
        feed_fields.counts(F.col("counts")).alias("counts"),
        feed_fields.locations(F.col("locations")).alias("locations"),
        *[F.split(c, sep).alias(c) for c, sep in lists.items()],
        scalars.split_ids(F.col("event_ids"), default=-1).alias("event_ids"),
        *feed_fields.tone_columns(F.col("tone_vec")),
    )


def dated_events(bronze: DataFrame) -> DataFrame:
    """The file-based variant of events: raw columns with real dates."""
    return bronze.withColumns(
        {c: scalars.int_date(F.col(c)) for c in ("ev_date", "date_added")}
    )


def listed_counts(bronze: DataFrame, default_id: int | None = -1) -> DataFrame:
    """The file-based variant of counts: date and list columns, bad ids as `default_id`."""
    return bronze.withColumns(
        {
            "pub_date": scalars.int_date(F.col("pub_date")),
            "sources": F.split("sources", ";"),
            "source_urls": F.split("source_urls", "<UDIV>"),
            "event_ids": scalars.split_ids(F.col("event_ids"), default=default_id),
        }
    )


def silver_counts(bronze: DataFrame, d: Dictionaries) -> DataFrame:
    """Counts with dates, lists, place parts and descriptions."""
    parts = F.col("parts")
    df = (
        listed_counts(bronze, default_id=None)
        .withColumn("parts", geo.name_parts(F.col("geo_full_name")))
        .withColumns({"geo_location": geo.location_part(parts), "geo_state": geo.state_part(parts)})
        .drop("parts")
    )
    lookups = [
        (d.geo_type, "geo_id", "geo_type", "geo_type_desc", "geo_type"),
        (d.fips_country, "geo_country_code", "fips_country_code", "country_name", "geo_country"),
    ]
    return describe_all(df, lookups).select(*schemas.SILVER_COUNTS_COLUMNS)


def placed_events(bronze: DataFrame) -> DataFrame:
    """Raw events with the parts of their action place."""
    parts = F.col("parts")
    places = {
        "country": geo.country_part(parts),
        "state": geo.state_part(parts),
        "city": geo.city_part(parts),
    }
    named = bronze.withColumn("parts", geo.name_parts(F.col("action_geo_full_name")))
    return named.withColumns(places).drop("parts")


def enriched_events(bronze: DataFrame, d: Dictionaries) -> DataFrame:
    """The view behind the aggregate tables: raw events, place parts, zone, descriptions."""
    df = placed_events(bronze)
    df = describe_all(
        df,
        [
            (d.quad_classes, "quad_class", "quad_class", "ev_desc", "quad_class_desc"),
            (d.cameo_event, "ev_root_code", "ev_code", "ev_desc", "ev_root_desc"),
            (d.cameo_event, "ev_base_code", "ev_code", "ev_desc", "ev_base_desc"),
            (d.cameo_event, "ev_code", "ev_code", "ev_desc", "ev_desc"),
            (d.fips_country, "a1_geo_country_code", "fips_country_code", "country_name", "a1_country"),
            (d.fips_country, "a2_geo_country_code", "fips_country_code", "country_name", "a2_country"),
            (d.fips_country, "action_geo_country_code", "fips_country_code", "country_name",
             "action_geo_country"),
            (d.cameo_actor_type, "a1_type1_code", "a_type_code", "a_type_desc", "a1_type1_desc"),
            (d.cameo_actor_type, "a2_type1_code", "a_type_code", "a_type_desc", "a2_type1_desc"),
        ],
    )
    zone = geo.zone_path(F.col("action_geo_country_code"), F.col("country"), F.col("state"))
    return df.withColumn("geo_zone", zone)


def describe_codes(events: DataFrame, d: Dictionaries) -> DataFrame:
    """Default-named descriptions for the nine interesting codes of an event."""
    event = (d.cameo_event, "ev_code", "ev_desc")
    actor = (d.cameo_actor_type, "a_type_code", "a_type_desc")
    nation = (d.cameo_country, "cameo_country_code", "country_name")
    plan = [
        ("quad_class", (d.quad_classes, "quad_class", "ev_desc")),
        ("ev_code", event), ("ev_base_code", event), ("ev_root_code", event),
        ("a1_type1_code", actor), ("a1_country_code", nation),
        ("a2_type1_code", actor), ("a2_country_code", nation),
        ("action_geo_country_code", (d.fips_country, "fips_country_code", "country_name")),
    ]
    return describe_all(events, [(dim, c, k, v, None) for c, (dim, k, v) in plan])
