"""Dense grids and forecasts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry.base import EV_SQL, R, bronze, dicts, ev, query, rounded
from registry.indicators import HEAT_CTE, ZONE_DAY_CTE, ZONE_DAY_KEYS, hot_events, zone_events
from registry.relational import SILVER_CTE
from tinderbox.operators import aggregates as A
from tinderbox.operators import series as S
from tinderbox.operators.medians import exact_medians
from tinderbox.plans import gold, silver

END = date(2024, 1, 31)
Z = S.Z80

LOCATION_CTE = f"""{HEAT_CTE}, loc AS (SELECT indicator_date, country_code, country, geo_zone,
    count(ev_id) AS frequency,
    sum(ln(1 + num_mentions) * heat_indicator) / sum(ln(1 + num_mentions)) AS heat_indicator
  FROM heat GROUP BY 1, 2, 3, 4),
  recent AS (SELECT * FROM loc WHERE indicator_date > DATE '2024-01-31' - INTERVAL 3 MONTH),
  means AS (SELECT indicator_date, country_code, country, avg(heat_indicator) AS m FROM recent GROUP BY 1, 2, 3),
  series AS (SELECT d.indicator_date, k.country_code, k.country, coalesce(m.m, 0) AS y
    FROM (SELECT DISTINCT indicator_date FROM recent) d
    CROSS JOIN (SELECT DISTINCT country_code, country FROM recent) k
    LEFT JOIN means m ON m.indicator_date = d.indicator_date AND m.country_code = k.country_code)"""


def _locations(spark, d):
    return gold.heat_by_location(hot_events(spark, d))


@query(
    "country_series",
    f"WITH {LOCATION_CTE} SELECT indicator_date, country_code, country, {R('y')} AS heat_indicator FROM series",
)
def _(spark, d):
    recent = S.recent_months(_locations(spark, d), "indicator_date", END)
    return rounded(S.mean_series(recent, "indicator_date", ["country_code", "country"], "heat_indicator"))


@query(
    "grid_fill",
    f"""WITH {ZONE_DAY_CTE} SELECT d.ev_date, k.geo_zone, k.country,
      {R('coalesce(z.heat_indicator, 0)')} AS heat_indicator, coalesce(z.frequency, 0) AS frequency
    FROM (SELECT DISTINCT ev_date FROM zd WHERE ev_date > DATE '2020-01-01') d
    CROSS JOIN (SELECT DISTINCT geo_zone, country FROM zd WHERE ev_date > DATE '2020-01-01') k
    LEFT JOIN zd z ON z.ev_date = d.ev_date AND z.geo_zone = k.geo_zone AND z.country = k.country""",
)
def _(spark, d):
    facts = A.zone_means(zone_events(spark, d), ZONE_DAY_KEYS, "heat")
    filled = S.dense_grid(
        facts, "ev_date", ["geo_zone", "country"], ["heat_indicator", "frequency"], date(2020, 1, 1)
    )
    return rounded(filled)


def _fit(source: str, keys: str, day: str) -> str:
    """SQL of the additive model: trend, weekday means of the residuals, remaining spread."""
    using = f"USING ({keys})"
    return f"""pts AS (SELECT {keys}, {day} AS ds, date_diff('day', DATE '1970-01-01', {day}) AS t,
      CAST(y AS DOUBLE) AS y, (isodow({day}) - 1) AS wd FROM {source}),
    line AS (SELECT {keys}, max(ds) AS last_day, avg(y) AS my, avg(t) AS mt,
      coalesce(regr_slope(y, t), 0) AS slope FROM pts GROUP BY ALL),
    res AS (SELECT {keys}, ds, wd, y - my - slope * (t - mt) AS r FROM pts JOIN line {using}),
    eff AS (SELECT {keys}, wd, avg(r) AS e FROM res GROUP BY ALL),
    sig AS (SELECT {keys}, sqrt(avg((r - e) * (r - e))) AS sigma FROM res JOIN eff USING ({keys}, wd) GROUP BY ALL)"""


def _ahead(keys: str, step: str, n: int) -> str:
    shown = f"my + slope * (date_diff('day', DATE '1970-01-01', ds) - mt) + coalesce(e, 0)"
    return f"""ahead AS (SELECT line.*, CAST({step} AS DATE) AS ds FROM line
      CROSS JOIN (SELECT unnest(generate_series(1, {n})) AS i) h),
    pred AS (SELECT {', '.join('a.' + k.strip() for k in keys.split(','))}, a.ds, {shown.replace('ds)', 'a.ds)')} AS yhat, sigma
      FROM ahead a JOIN sig USING ({keys})
      LEFT JOIN eff ON {' AND '.join(f'eff.{k.strip()} = a.{k.strip()}' for k in keys.split(','))}
        AND eff.wd = isodow(a.ds) - 1)"""


_BAND = f"""{R('yhat')} AS yhat, {R(f'yhat - {Z} * sigma')} AS yhat_lower, {R(f'yhat + {Z} * sigma')} AS yhat_upper"""


@query(
    "forecast_7d",
    f"""WITH {LOCATION_CTE}, {_fit('series', 'country_code, country', 'indicator_date')},
    {_ahead('country_code, country', 'last_day + CAST(i AS INTEGER)', 7)}
    SELECT ds AS indicator_date, country_code, country, {_BAND}, DATE '2024-01-31' AS date_predicted FROM pred""",
)
def _(spark, d):
    return rounded(gold.country_forecast(_locations(spark, d), END))


@query(
    "forecast_zone",
    f"""WITH {ZONE_DAY_CTE}, grid AS (SELECT d.ev_date, k.geo_zone, k.country, coalesce(z.heat_indicator, 0) AS y
      FROM (SELECT DISTINCT ev_date FROM zd) d CROSS JOIN (SELECT DISTINCT geo_zone, country FROM zd) k
      LEFT JOIN zd z ON z.ev_date = d.ev_date AND z.geo_zone = k.geo_zone AND z.country = k.country),
    {_fit('grid', 'geo_zone, country', 'ev_date')},
    {_ahead('geo_zone, country', 'last_day + CAST(8 - isodow(last_day + 1) AS INTEGER) + CAST(i - 1 AS INTEGER) * 7', 1)},
    c AS (SELECT geo_zone, median(lat) AS lat, median(lon) AS lon FROM zd GROUP BY 1)
    SELECT ds AS indicator_date, geo_zone, country, {_BAND}, {R('lat')} AS lat, {R('lon')} AS lon
    FROM pred JOIN c USING (geo_zone)""",
)
def _(spark, d):
    hot = zone_events(spark, d)
    daily = exact_medians(hot, ZONE_DAY_KEYS, ["lat", "lon"])
    centroids = A.zone_centroid(daily, ["geo_zone"], "lat", "lon")
    means = A.zone_means(hot, ZONE_DAY_KEYS, "heat")
    grid = S.dense_grid(means, "ev_date", ["geo_zone", "country"], ["heat_indicator", "frequency"])
    return rounded(gold.zone_forecast(grid.withColumnRenamed("ev_date", "indicator_date"), centroids))


@query(
    "forecast_trend",
    f"""WITH {EV_SQL}, s AS (SELECT country, date_added AS ds, count(*) AS y FROM ev
      WHERE country IS NOT NULL GROUP BY 1, 2),
    f AS (SELECT country, max(ds) AS last_day, regr_slope(y, date_diff('day', DATE '1970-01-01', ds)) AS slope,
      regr_intercept(y, date_diff('day', DATE '1970-01-01', ds)) AS intercept FROM s GROUP BY 1)
    SELECT country, CAST(last_day + CAST(i AS INTEGER) AS DATE) AS ds,
      {R("intercept + slope * (date_diff('day', DATE '1970-01-01', last_day) + i)")} AS yhat
    FROM f CROSS JOIN (SELECT unnest(generate_series(1, 7)) AS i) h""",
)
def _(spark, d):
    counts = ev(spark, d).where("country IS NOT NULL").groupBy("country", F.col("date_added").alias("day"))
    return rounded(S.trend_forecast(counts.agg(F.count(F.lit(1)).alias("y")), ["country"], "day", "y", 7))


_ZONE = """CASE WHEN action_geo_country_code IN ('US', 'CH', 'BR', 'IN', 'IS', 'RS', 'UK')
    THEN action_geo_state ELSE action_geo_country END"""


@query(
    "conflict_zone_forecast",
    f"""WITH {SILVER_CTE}, zd AS (SELECT ev_date, {_ZONE} AS geo_zone, action_geo_country AS country,
      avg((gstein_scale + avg_tone) / 2 * num_mentions) AS heat_indicator,
      median(action_geo_lat) AS lat, median(action_geo_lon) AS lon FROM silver
      WHERE ev_root_code IN ('13', '14', '18', '20') AND ({_ZONE}) IS NOT NULL GROUP BY 1, 2, 3),
    grid AS (SELECT d.ev_date, k.geo_zone, k.country, coalesce(z.heat_indicator, 0) AS y
      FROM (SELECT DISTINCT ev_date FROM zd) d CROSS JOIN (SELECT DISTINCT geo_zone, country FROM zd) k
      LEFT JOIN zd z ON z.ev_date = d.ev_date AND z.geo_zone = k.geo_zone AND z.country = k.country),
    {_fit('grid', 'geo_zone, country', 'ev_date')},
    {_ahead('geo_zone, country', 'last_day + CAST(8 - isodow(last_day + 1) AS INTEGER) + CAST(i - 1 AS INTEGER) * 7', 1)},
    c AS (SELECT geo_zone, median(lat) AS lat, median(lon) AS lon FROM zd GROUP BY 1)
    SELECT ds AS indicator_date, geo_zone, country, {_BAND}, {R('lat')} AS lat, {R('lon')} AS lon
    FROM pred JOIN c USING (geo_zone)""",
)
def _(spark, d):
    events = silver.silver_events(bronze(spark, d), dicts(spark, d))
    return rounded(gold.zone_forecast(*gold.zone_series(events)))
