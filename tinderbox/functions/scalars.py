"""Tolerant casts, list splitting and date helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how dates are written in file names, a year after 999, month and day, with or without dashes.
DATE_PATTERN = "[1-9][0-9]{3}-?[0-9]{2}-?[0-9]{2}"


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def present(c: Column) -> Column:
    """Neither NULL nor NaN (for floating columns)."""
    return c.isNotNull() & ~F.isnan(c)


def filled(c: Column) -> Column:
    """Neither NULL nor the empty string."""
    return c.isNotNull() & (c != "")


def split_list(c: Column, sep: str) -> Column:
    """Split on a literal separator after dropping one trailing separator; blank is NULL."""
    literal = re.escape(sep)
    return F.split(blank_to_null(F.regexp_replace(c, f"{literal}$", "")), literal)


def split_ids(c: Column, sep: str = ",", default: int | None = None) -> Column:
    """Array of 64-bit ids; an unreadable id becomes `default`."""

    def one(x: Column) -> Column:
        n = F.trim(x).try_cast("bigint")
        return n if default is None else F.coalesce(n, F.lit(default).cast("bigint"))

    return F.transform(F.split(c, re.escape(sep)), one)


def int_date(c: Column) -> Column:
    """20240811 -> 2024-08-11, NULL when it is no calendar day."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def date_int(c: Column) -> Column:
    """2024-08-11 -> 20240811."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def int_or(c: Column, default: int | None = None) -> Column:
    n = F.trim(c).try_cast("bigint")
    return n if default is None else F.coalesce(n, F.lit(default).cast("bigint"))


def ensure_float(c: Column) -> Column:
    """Read a double; failing that, read what remains of its digits, dots and dashes."""
    digits = blank_to_null(F.regexp_replace(c, r"[^0-9.\-]", ""))
    return F.coalesce(c.try_cast("double"), digits.try_cast("double"))


def extract_dates(c: Column) -> Column:
    """All calendar days written in a text, in order."""
    found = F.regexp_extract_all(c, F.lit(DATE_PATTERN), F.lit(0))
    return F.array_compact(
        F.transform(found, lambda d: F.try_to_date(F.replace(d, F.lit("-"), F.lit("")), "yyyyMMdd"))
    )


def file_stamp(c: Column) -> Column:
    """Leading date part of a feed file name."""
    return F.split_part(c, F.lit("."), F.lit(1))


def sample_suffix(c: Column) -> Column:
    """`.sampled_0.1` of a sampled feed file name, blank for a full file."""
    return F.regexp_extract(c, r"(\.sampled_[0-9.]+)\.zip", 1)


def r6(c: Column) -> Column:
    """Round for comparison across engines; adding zero removes a negative zero."""
    return F.round(c, 6) + F.lit(0.0)
