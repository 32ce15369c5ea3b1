"""Date windows, date sequences and column checks."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOME_ZONE = ZoneInfo("US/Eastern")  # fixed value: the jobs' calendar


def today() -> date:
    return datetime.now(tz=HOME_ZONE).date()


def _day(value: str | date | None) -> date | None:
    if value in (None, ""):
        return None
    return value if isinstance(value, date) else date.fromisoformat(value)


def job_window(
    start: str | date | None = None,
    end: str | date | None = None,
    lookback_days: int | str | None = None,
    now: date | None = None,
) -> tuple[date, date]:
    """Both days given, or `lookback_days` up to today, or just today."""
    now = now or today()
    first, last = _day(start), _day(end)
    if first and last:
        return first, last
    if lookback_days not in (None, ""):
        return now - timedelta(days=int(lookback_days)), now
    return now, now


def window_from_values(
    start: date | None, end: date | None, lookback_days: int | None, now: date | None = None
) -> tuple[date, date]:
    """Each bound on its own: missing end is today, missing start is `lookback_days` (1) ago."""
    now = now or today()
    back = 1 if lookback_days is None else int(lookback_days)
    return start or now - timedelta(days=back), end or now


def in_window(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Inclusive range on a date column; prunes partitions when it is the partition column."""
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def in_int_window(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """The same for a raw YYYYMMDD column, compared as integers so that it still prunes."""
    low, high = (int(d.strftime("%Y%m%d")) for d in (start, end))
    return df.where(F.col(column).between(low, high))


def daily_stamps(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """`YYYYMMDD` of every day in [start, end) of each row; empty when start >= end."""
    days = F.sequence(F.col(start), F.date_sub(F.col(end), 1))
    return bounds.where(F.col(start) < F.col(end)).select(
        F.explode(F.transform(days, lambda d: F.date_format(d, "yyyyMMdd"))).alias("date_str")
    )


def quarter_hour_stamps(
    bounds: DataFrame, start: str, end: str, fraction: float = 1.0, seed: int = 0
) -> DataFrame:
    """`YYYYMMDDHHMM00` every 15 minutes of [start, end), optionally a Bernoulli sample."""
    first = F.col(start).cast("timestamp_ntz")
    last = F.col(end).cast("timestamp_ntz") - F.expr("interval 15 minutes")
    steps = F.sequence(first, last, F.expr("interval 15 minutes"))
    stamps = bounds.where(F.col(start) < F.col(end)).select(
        F.explode(F.transform(steps, lambda t: F.date_format(t, "yyyyMMddHHmmss"))).alias(
            "date_str"
        )
    )
    return stamps if fraction >= 1.0 else stamps.sample(fraction=fraction, seed=seed)


def require_distinct_columns(df: DataFrame) -> DataFrame:
    names = df.columns
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"duplicate columns: {twice}")
    return df
