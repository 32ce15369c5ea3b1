"""Place names and geographic zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Countries that are divided into zones, by variant.
HEAT_ZONE_COUNTRIES = ["US", "CH", "RS", "IN", "BR"]
WIDE_ZONE_COUNTRIES = ["US", "CH", "BR", "IS", "IN", "UK", "RS"]


def name_parts(full_name: Column) -> Column:
    """Comma-separated parts of a place name.

    Give them a column of their own before taking parts, so that a name is split once.
    """
    return F.split(full_name, ",")


def _from_end(parts: Column, k: int) -> Column:
    return F.trim(F.get(parts, F.size(parts) - k))


def country_part(parts: Column) -> Column:
    return _from_end(parts, 1)


def state_part(parts: Column) -> Column:
    """Second part from the end, NULL when the name has one part."""
    return _from_end(parts, 2)


def city_part(parts: Column) -> Column:
    return _from_end(parts, 3)


def location_part(parts: Column) -> Column:
    """First part of a name with exactly three parts."""
    return F.trim(F.when(F.size(parts) == 3, F.get(parts, F.lit(0))))


def zone_path(
    code: Column, country: Column, state: Column, divided: list[str] = WIDE_ZONE_COUNTRIES
) -> Column:
    """`country/state` in divided countries (NULL without a state), else the country."""
    return F.when(code.isin(divided), F.concat(country, F.lit("/"), state)).otherwise(country)


def zone_label(
    code: Column, country: Column, state: Column, divided: list[str] = HEAT_ZONE_COUNTRIES
) -> Column:
    """`country / state` where a divided country has a state of another name."""
    has_state = state.isNotNull() & (state != country)
    return F.when(
        code.isin(divided) & has_state, F.concat(country, F.lit(" / "), state)
    ).otherwise(country)


def zone_state(
    code: Column, country: Column, state: Column, divided: list[str] = WIDE_ZONE_COUNTRIES
) -> Column:
    """The state itself in divided countries, else the country."""
    return F.when(code.isin(divided), state).otherwise(country)
