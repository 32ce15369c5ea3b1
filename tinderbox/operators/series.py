"""Daily series: dense grids and per-key forecasts.

A series has at most one row per key and day, so a key's history is bounded by the length of
the training window and may be handled in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tinderbox.operators.joins import join_null_safe

Z80 = 1.2815515655446004  # fixed value: normal quantile of an 80 % interval


def recent_months(df: DataFrame, column: str, end: date, months: int = 3) -> DataFrame:
    """Rows later than `months` months before `end`."""
    start = F.add_months(F.lit(end), -months)
    return df.where(F.col(column) > start)


def dense_grid(
    facts: DataFrame, day: str, keys: list[str], fill: list[str], since: date | None = None
) -> DataFrame:
    """Every observed day for every observed key, missing facts filled with 0.

    The observed days (bounded by the calendar) are one array in a scalar subquery that is
    exploded per key; there is no cross join. `facts` has one row per day and keys.
    """
    base = facts if since is None else facts.where(F.col(day) > F.lit(since))
    days = base.agg(F.array_sort(F.collect_set(day))).scalar()
    grid = base.select(*keys).distinct().withColumn(day, F.explode(days))
    filled = join_null_safe(grid, facts, [day, *keys], "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in fill})


def mean_series(facts: DataFrame, day: str, keys: list[str], value: str) -> DataFrame:
    """Mean value per day and key with missing days as 0."""
    means = facts.groupBy(day, *keys).agg(F.avg(value).alias(value))
    return dense_grid(means, day, keys, [value])


def log_series(counts: DataFrame, id_parts: list[str], day: str, count: str) -> DataFrame:
    """Long format (unique_id, ds, y) with y = log10(1 + count)."""
    return counts.select(
        F.concat(*[p for c in id_parts for p in (F.lit("-"), F.col(c))][1:]).alias("unique_id"),
        F.col(day).alias("ds"),
        F.log10(F.col(count) + 1).alias("y"),
    )


def _weekday(day: Column) -> Column:
    return F.weekday(day)


def _step(last: Column, i: Column, freq: str) -> Column:
    """i-th future day: the next days, or the next Sundays."""
    if freq == "D":
        return F.date_add(last, i)
    if freq == "W":
        return F.date_add(F.next_day(last, "SU"), (i - 1) * 7)
    raise ValueError(f"unknown frequency {freq!r}")


def additive_forecast(
    series: DataFrame, keys: list[str], day: str, value: str, horizon: int, freq: str = "D"
) -> DataFrame:
    """Linear trend plus weekday effects with an 80 % band, in built-in functions.

    One shuffle by key: trend, weekday means of the residuals and the remaining spread are
    windows over the same partitioning.
    """
    per_key = Window.partitionBy(*keys)
    per_weekday = Window.partitionBy(*keys, "wd")
    t = F.unix_date(day)
    fitted = (
        series.where(F.col(value).isNotNull())
        .withColumn("t", t.cast("double"))
        .withColumn("y", F.col(value).cast("double"))
        .withColumn("wd", _weekday(F.col(day)))
        .withColumn("mean_y", F.avg("y").over(per_key))
        .withColumn("mean_t", F.avg("t").over(per_key))
        .withColumn("slope", F.coalesce(F.regr_slope("y", "t").over(per_key), F.lit(0.0)))
        .withColumn(
            "residual",
            F.col("y") - F.col("mean_y") - F.col("slope") * (F.col("t") - F.col("mean_t")),
        )
        .withColumn("effect", F.avg("residual").over(per_weekday))
    )
    noise = F.col("residual") - F.col("effect")
    model = fitted.groupBy(*keys).agg(
        F.max(day).alias("last_day"),
        F.first("mean_y").alias("mean_y"),
        F.first("mean_t").alias("mean_t"),
        F.first("slope").alias("slope"),
        F.sqrt(F.avg(noise * noise)).alias("sigma"),
        # seven entries at most
        F.map_from_entries(F.collect_set(F.struct("wd", "effect"))).alias("effects"),
    )
    ahead = model.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "ds", _step(F.col("last_day"), F.col("i"), freq)
    )
    trend = F.col("mean_y") + F.col("slope") * (F.unix_date("ds") - F.col("mean_t"))
    effect = F.coalesce(F.try_element_at("effects", _weekday(F.col("ds"))), F.lit(0.0))
    return ahead.withColumn("yhat", trend + effect).select(
        *keys,
        "ds",
        "yhat",
        (F.col("yhat") - Z80 * F.col("sigma")).alias("yhat_lower"),
        (F.col("yhat") + Z80 * F.col("sigma")).alias("yhat_upper"),
    )


def trend_forecast(
    series: DataFrame, keys: list[str], day: str, value: str, horizon: int
) -> DataFrame:
    """Straight-line continuation of each series."""
    t = F.unix_date(day)
    line = series.groupBy(*keys).agg(
        F.max(day).alias("last_day"),
        F.regr_slope(F.col(value), t).alias("slope"),
        F.regr_intercept(F.col(value), t).alias("intercept"),
    )
    ahead = line.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "ds", F.date_add("last_day", F.col("i"))
    )
    yhat = F.col("intercept") + F.col("slope") * F.unix_date("ds")
    return ahead.select(*keys, "ds", yhat.alias("yhat"))


Forecaster = Callable[[pd.DataFrame, int, str], pd.DataFrame]


def additive_model(history: pd.DataFrame, horizon: int, freq: str) -> pd.DataFrame:
    """The model of `additive_forecast` for one key: (ds, y) -> (ds, yhat, bounds)."""
    ds = pd.to_datetime(history["ds"])
    t = ds.to_numpy().astype("datetime64[D]").astype("int64").astype(float)
    y = history["y"].to_numpy(dtype=float)
    centred = t - t.mean()
    spread = (centred**2).sum()
    slope = (centred * (y - y.mean())).sum() / spread if spread > 0 else 0.0
    residual = pd.Series(y - y.mean() - slope * centred)
    weekday = pd.Series(ds.dt.weekday.to_numpy())
    effects = residual.groupby(weekday).mean()
    sigma = float(np.sqrt(((residual - weekday.map(effects)) ** 2).mean()))

    rule = {"D": "D", "W": "W-SUN"}[freq]
    start = ds.max() + pd.Timedelta(days=1)
    future = pd.date_range(start, periods=horizon, freq=rule)
    tf = future.to_numpy().astype("datetime64[D]").astype("int64").astype(float)
    effect = pd.Series(future.weekday).map(effects).fillna(0.0).to_numpy()
    yhat = y.mean() + slope * (tf - t.mean()) + effect
    return pd.DataFrame(
        {
            "ds": future.date,
            "yhat": yhat,
            "yhat_lower": yhat - Z80 * sigma,
            "yhat_upper": yhat + Z80 * sigma,
        }
    )


def forecast_groups(
    series: DataFrame,
    keys: list[str],
    day: str,
    value: str,
    horizon: int,
    freq: str = "D",
    forecaster: Forecaster = additive_model,
) -> DataFrame:
    """Fit any per-key model on the executors; one task call sees one key's daily history."""
    fields = [series.schema[k] for k in keys]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in fields]
        + [T.StructField("ds", T.DateType())]
        + [T.StructField(c, T.DoubleType()) for c in ("yhat", "yhat_lower", "yhat_upper")]
    )

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        history = rows.rename(columns={day: "ds", value: "y"})[["ds", "y"]].sort_values("ds")
        out = forecaster(history, horizon, freq)
        for name, v in zip(keys, key, strict=True):
            out[name] = v
        return out[[*keys, "ds", "yhat", "yhat_lower", "yhat_upper"]]

    slim = series.where(F.col(value).isNotNull()).select(*keys, day, value)
    return slim.groupBy(*keys).applyInPandas(fit, schema)


def with_attributes(
    predictions: DataFrame, attributes: DataFrame, keys: list[str], made_on: date | None = None
) -> DataFrame:
    """Attach key attributes (country, position) and, if given, the prediction date."""
    out = join_null_safe(predictions, attributes, keys, "inner").withColumnRenamed(
        "ds", "indicator_date"
    )
    return out if made_on is None else out.withColumn("date_predicted", F.lit(made_on))
