"""Heat, weighted aggregates, rollups and zone tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry.base import EV_SQL, ORACLES, R, bronze, dicts, ev, query, rounded
from registry.relational import ENRICHED_CTE, SILVER_CTE
from tinderbox.functions import geo, heat
from tinderbox.functions.scalars import blank_to_null
from tinderbox.operators import aggregates as A
from tinderbox.operators.medians import exact_medians
from tinderbox.plans import daily, gold, silver
from tinderbox.session import new_dir
from tinderbox.sinks import writers

_DIVIDED = ["0", "3", "7"]


def _named(spark, d):
    """The event view in heat vocabulary; its divided countries are the keys 0, 3 and 7."""
    return (
        ev(spark, d)
        .withColumn("country_code", F.col("geo_key").cast("string"))
        .withColumnRenamed("ev_date", "indicator_date")
    )


HEAT_CTE = f"""{EV_SQL}, heat AS (SELECT *, CAST(geo_key AS VARCHAR) AS country_code,
    ev_date AS indicator_date, gstein_scale * gstein_scale AS heat_indicator,
    CASE WHEN geo_key IN (0, 3, 7) AND state IS NOT NULL AND state <> country
         THEN country || ' / ' || state ELSE country END AS geo_zone
  FROM ev WHERE gstein_scale < 0 AND geo_key IS NOT NULL)"""


def hot_events(spark, d):
    return gold.heat_columns(_named(spark, d), _DIVIDED)


@query(
    "heat_by_event",
    f"""WITH {HEAT_CTE} SELECT ev_id, date_added, indicator_date, country_code, country, state,
      geo_zone, {R('heat_indicator')} AS heat_indicator FROM heat""",
)
def _(spark, d):
    return rounded(
        hot_events(spark, d).select(
            "ev_id", "date_added", "indicator_date", "country_code", "country", "state",
            "geo_zone", "heat_indicator",
        )
    )


@query(
    "heat_by_location",
    f"""WITH {HEAT_CTE} SELECT indicator_date, country_code, country, geo_zone,
      count(ev_id) AS frequency,
      {R('sum(ln(1 + num_mentions) * heat_indicator) / sum(ln(1 + num_mentions))')} AS heat_indicator
    FROM heat GROUP BY 1, 2, 3, 4""",
)
def _(spark, d):
    return rounded(gold.heat_by_location(hot_events(spark, d)))


@query(
    "heat_by_location_medians",
    f"""WITH {HEAT_CTE} SELECT indicator_date, country_code, country, geo_zone,
      count(*) AS frequency, {R('avg(heat_indicator)')} AS heat_indicator,
      {R('median(lat)')} AS lat, {R('median(lon)')} AS lon
    FROM heat GROUP BY 1, 2, 3, 4""",
)
def _(spark, d):
    keys = ["indicator_date", "country_code", "country", "geo_zone"]
    return rounded(A.zone_day(hot_events(spark, d), keys, "heat_indicator", "lat", "lon"))


@query(
    "silver_to_heat",
    f"""WITH {SILVER_CTE} SELECT date_added, ev_id, ev_date AS indicator_date,
      action_geo_country_code AS country_code, action_geo_country AS country,
      action_geo_state AS state, {R('gstein_scale * gstein_scale')} AS heat_indicator,
      CASE WHEN action_geo_country_code IN ('US', 'CH', 'RS', 'IN', 'BR')
        AND action_geo_state IS NOT NULL AND action_geo_state <> action_geo_country
        THEN action_geo_country || ' / ' || action_geo_state ELSE action_geo_country END AS geo_zone
    FROM silver WHERE gstein_scale < 0 AND action_geo_country_code IS NOT NULL
      AND action_geo_country_code <> ''""",
)
def _(spark, d):
    hot = gold.heat_by_event(silver.silver_events(bronze(spark, d), dicts(spark, d)))
    return rounded(
        hot.select(
            "date_added", "ev_id", "indicator_date", "country_code", "country", "state",
            F.col("heat_indicator").cast("double").alias("heat_indicator"), "geo_zone",
        )
    )


@query(
    "heat_root_events",
    f"""WITH {ENRICHED_CTE} SELECT ev_date AS heat_date, ev_id,
      action_geo_country_code AS country_code, geo_zone, quad_class_desc, ev_root_desc, ev_desc,
      {R('ln(1 + num_mentions) * -CAST(gstein_scale AS DOUBLE)')} AS ev_heat,
      {R('action_geo_lat')} AS lat, {R('action_geo_lon')} AS lon, source_url, quad_class,
      ev_root_code, ev_base_code, ev_code FROM enriched WHERE is_root_event = 1""",
)
def _(spark, d):
    return rounded(gold.root_event_heat(silver.enriched_events(bronze(spark, d), dicts(spark, d))))


def _agg_sql(keys: str) -> str:
    def weighted(w: str) -> str:
        return R(f"sum(CAST(gstein_scale AS DOUBLE) * num_{w}) / sum(num_{w})")

    return f"""WITH {ENRICHED_CTE} SELECT {keys}, count(*) AS cnt,
      {R('sum(CAST(gstein_scale AS DOUBLE)) / count(*)')} AS avg_gstein,
      {weighted('mentions')} AS avg_gstein_weighted_mentions,
      {weighted('sources')} AS avg_gstein_weighted_sources,
      {weighted('articles')} AS avg_gstein_weighted_articles
    FROM (SELECT *, action_geo_country_code AS action_country_code,
      action_geo_country AS action_country FROM enriched) GROUP BY {keys}"""


def _enriched(spark, d):
    return silver.enriched_events(bronze(spark, d), dicts(spark, d))


@query(
    "agg_country_quad",
    _agg_sql("ev_date, action_country_code, action_country, quad_class, quad_class_desc"),
)
def _(spark, d):
    return rounded(gold.country_quad_class(_enriched(spark, d)))


@query(
    "agg_country_root",
    _agg_sql("date_added, action_country_code, action_country, ev_root_code, ev_root_desc"),
)
def _(spark, d):
    return rounded(gold.country_ev_root(_enriched(spark, d)))


@query(
    "agg_country_base",
    _agg_sql("ev_date, action_country_code, action_country, ev_base_code, ev_base_desc"),
)
def _(spark, d):
    return rounded(gold.country_ev_base(_enriched(spark, d)))


@query(
    "geo_rollup",
    f"""WITH {ENRICHED_CTE}, g AS (SELECT country, state, city,
        CAST(grouping(country, state, city) AS BIGINT) AS grouping_id,
        median(CAST(action_geo_lat AS DOUBLE)) AS lat, median(CAST(action_geo_lon AS DOUBLE)) AS lon,
        count(*) AS ev_count FROM enriched
      WHERE action_geo_lat IS NOT NULL AND action_geo_lon IS NOT NULL
      GROUP BY ROLLUP (country, state, city))
    SELECT country, state, city, grouping_id, {R('lat')} AS lat, {R('lon')} AS lon, ev_count,
      CAST(1 + CASE WHEN state IS NULL THEN 0 ELSE 1 END
             + CASE WHEN city IS NULL THEN 0 ELSE 1 END AS INTEGER) AS geo_granularity
    FROM g WHERE country IS NOT NULL""",
)
def _(spark, d):
    return rounded(gold.geo_locations(_enriched(spark, d)))


@query(
    "geo_zones",
    f"""WITH {ENRICHED_CTE} SELECT action_geo_country_code AS country_code, geo_zone,
      max(action_geo_country) AS country, count(*) AS ev_count,
      {R('median(CAST(action_geo_lat AS DOUBLE))')} AS lat,
      {R('median(CAST(action_geo_lon AS DOUBLE))')} AS lon
    FROM enriched WHERE action_geo_lat IS NOT NULL AND action_geo_lon IS NOT NULL
      AND country IS NOT NULL AND geo_zone IS NOT NULL GROUP BY 1, 2""",
)
def _(spark, d):
    return rounded(gold.geo_zones(_enriched(spark, d)))


def _place_tables(spark, d):
    """Half of the days, then the others and again one day that had been cut short: the tables of one full run."""
    lake, rows = daily.Lake(new_dir(spark, "lake")), bronze(spark, d)
    cut = rows.where("date_added < 20240115 AND (date_added <> 20240110 OR ev_id % 2 = 0)")
    for events, first, last in ((cut, date(2024, 1, 1), date(2024, 1, 14)), (rows.where("date_added >= 20240115 OR date_added = 20240110"), date(2024, 1, 10), date(2024, 12, 31))):
        writers.replace_present(events, lake.path("bronze_events"), "date_added")
        daily.refresh_place_tables(spark, lake, dicts(spark, d), first, last)
    return [rounded(writers.latest_snapshot(spark, lake.path(t))) for t in ("geo_locations_helper", "geo_zones_helper")]


@query("geo_rollup_increments", ORACLES["geo_rollup"])
def _(spark, d):
    return _place_tables(spark, d)[0]


@query("geo_zones_increments", ORACLES["geo_zones"])
def _(spark, d):
    return _place_tables(spark, d)[1]


_ZONES_SQL = """
  CASE WHEN geo_key IN (0, 3, 7) THEN country || '/' || state ELSE country END AS zone_path,
  CASE WHEN geo_key IN (0, 3, 7) AND state IS NOT NULL AND state <> country
       THEN country || ' / ' || state ELSE country END AS zone_label,
  CASE WHEN geo_key IN (0, 3, 7) THEN state ELSE country END AS zone_state"""


@query("geo_zone", f"WITH {EV_SQL} SELECT ev_id, {_ZONES_SQL} FROM ev")
def _(spark, d):
    code = F.col("geo_key").cast("string")
    args = (code, F.col("country"), F.col("state"), _DIVIDED)
    return ev(spark, d).select(
        "ev_id",
        geo.zone_path(*args).alias("zone_path"),
        geo.zone_label(*args).alias("zone_label"),
        geo.zone_state(*args).alias("zone_state"),
    )


@query(
    "geo_parts",
    f"""WITH {SILVER_CTE} SELECT ev_id, a1_geo_location, a1_geo_state, a2_geo_location,
      a2_geo_state, action_geo_location, action_geo_state FROM silver""",
)
def _(spark, d):
    split, parts = {}, {}
    for who in ("a1", "a2", "action"):
        split[f"{who}_parts"] = geo.name_parts(F.col(f"{who}_geo_full_name"))
        parts[f"{who}_geo_location"] = geo.location_part(F.col(f"{who}_parts"))
        parts[f"{who}_geo_state"] = geo.state_part(F.col(f"{who}_parts"))
    named = bronze(spark, d).withColumns(split)
    return named.select("ev_id", *[c.alias(n) for n, c in parts.items()])


@query("geo_parts_view", f"WITH {ENRICHED_CTE} SELECT ev_id, country, state, city FROM enriched")
def _(spark, d):
    parts = F.col("parts")
    named = bronze(spark, d).withColumn("parts", geo.name_parts(F.col("action_geo_full_name")))
    return named.select(
        "ev_id",
        geo.country_part(parts).alias("country"),
        geo.state_part(parts).alias("state"),
        geo.city_part(parts).alias("city"),
    )


# Tone in whole hundredths: sums stay exact, so no engine's order of addition shows.
_BLEND = "((gstein_scale + round(avg_tone * 100)) / 2) * num_mentions"
ZONE_DAY_CTE = f"""{EV_SQL}, zd AS (SELECT ev_date,
    CASE WHEN geo_key IN (0, 3, 7) THEN state ELSE country END AS geo_zone, country,
    avg({_BLEND}) AS heat_indicator, median(lat) AS lat, median(lon) AS lon, count(*) AS frequency
  FROM ev WHERE (CASE WHEN geo_key IN (0, 3, 7) THEN state ELSE country END) IS NOT NULL
  GROUP BY 1, 2, 3)"""


ZONE_DAY_KEYS = ["ev_date", "geo_zone", "country"]


def zone_events(spark, d):
    zone = geo.zone_state(F.col("geo_key").cast("string"), F.col("country"), F.col("state"), _DIVIDED)
    tone = F.round(F.col("avg_tone") * 100)
    blend = heat.tone_blend(F.col("gstein_scale"), tone, F.col("num_mentions"))
    return ev(spark, d).withColumns({"geo_zone": zone, "heat": blend}).where("geo_zone IS NOT NULL")


@query(
    "zone_day_heat",
    f"""WITH {ZONE_DAY_CTE} SELECT ev_date, geo_zone, country, {R('heat_indicator')} AS heat_indicator,
      {R('lat')} AS lat, {R('lon')} AS lon, frequency FROM zd""",
)
def _(spark, d):
    return rounded(A.zone_day(zone_events(spark, d), ZONE_DAY_KEYS, "heat", "lat", "lon"))


@query(
    "zone_centroid",
    f"""WITH {ZONE_DAY_CTE} SELECT geo_zone, {R('median(lat)')} AS lat, {R('median(lon)')} AS lon
    FROM zd GROUP BY geo_zone""",
)
def _(spark, d):
    daily = exact_medians(zone_events(spark, d), ZONE_DAY_KEYS, ["lat", "lon"])
    return rounded(A.zone_centroid(daily, ["geo_zone"], "lat", "lon"))


@query(
    "log_counts",
    f"""WITH {ENRICHED_CTE} SELECT quad_class_desc, ev_root_desc, ev_desc, count(*) AS cnt,
      {R('ln(1 + count(*))')} AS log_1p_cnt,
      coalesce(quad_class_desc || ' - ' || coalesce(ev_root_desc, '') || ' - ' || ev_desc, '') AS full_desc
    FROM enriched GROUP BY 1, 2, 3""",
)
def _(spark, d):
    return rounded(gold.event_descriptions(_enriched(spark, d)))


@query(
    "country_share",
    f"""WITH {ENRICHED_CTE} SELECT action_geo_country AS country, count(*) AS cnt,
      {R('ln(1 + count(*))')} AS log_1p_cnt, {R('count(*) / sum(count(*)) OVER ()')} AS fraction
    FROM enriched GROUP BY 1""",
)
def _(spark, d):
    named = _enriched(spark, d).withColumn("country", F.col("action_geo_country"))
    return rounded(A.share_of_total(A.log_counts(named, ["country"])))


@query(
    "known_zones",
    f"""WITH {EV_SQL} SELECT geo_key, nullif(state, '') AS state, count(*) AS cnt FROM ev
    WHERE geo_key IS NOT NULL GROUP BY 1, 2""",
)
def _(spark, d):
    known = ev(spark, d).where("geo_key IS NOT NULL").withColumn("state", blank_to_null(F.col("state")))
    return known.groupBy("geo_key", "state").agg(F.count(F.lit(1)).alias("cnt"))
