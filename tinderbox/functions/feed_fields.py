"""Nested text fields of the knowledge-graph feed, parsed with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tinderbox import schemas


def _field(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def _place(parts: Column, first: int) -> list[Column]:
    """The seven location fields that start at `first`."""
    kind = F.nullif(_field(parts, first), F.lit(""))
    names = F.create_map(*[F.lit(x) for kv in schemas.LOCATION_TYPES.items() for x in kv])
    return [
        F.coalesce(F.try_element_at(names, kind), kind).alias("LocationType"),
        _field(parts, first + 1).alias("LocationName"),
        _field(parts, first + 2).alias("CountryCode"),
        _field(parts, first + 3).alias("ADM1Code"),
        _field(parts, first + 4).try_cast("float").alias("Latitude"),
        _field(parts, first + 5).try_cast("float").alias("Longitude"),
        _field(parts, first + 6).alias("LocationFeatureID"),
    ]


def _blocks(c: Column, build) -> Column:
    """`;` blocks of `#` fields; blank blocks are skipped, no block at all is NULL."""
    rows = F.transform(
        F.filter(F.split(c, ";"), lambda block: block != ""), lambda block: F.split(block, "#")
    )
    return F.transform(F.when(F.size(rows) > 0, rows), build)


def counts(c: Column) -> Column:
    """Array of count entries (ten fields)."""

    def entry(p: Column) -> Column:
        number = F.when(_field(p, 1).rlike("^[0-9]+$"), _field(p, 1).try_cast("int"))
        return F.struct(
            _field(p, 0).alias("Type"),
            number.alias("Count"),
            _field(p, 2).alias("ObjectType"),
            *_place(p, 3),
        )

    return _blocks(c, entry)


def locations(c: Column) -> Column:
    """Array of location entries (seven fields)."""
    return _blocks(c, lambda p: F.struct(*_place(p, 0)))


def _tone_value(parts: Column, i: int) -> Column:
    return _field(parts, i).try_cast("float")


def tone(c: Column) -> Column:
    """Struct of six floats; the struct stays even when the text is missing."""
    parts = F.split(c, ",")
    return F.struct(
        *[_tone_value(parts, i).alias(n) for i, n in enumerate(schemas.TONE_FIELDS)]
    )


def tone_columns(c: Column) -> list[Column]:
    """The same six numbers as flat columns."""
    parts = F.split(c, ",")
    return [_tone_value(parts, i).alias(n) for i, n in enumerate(schemas.TONE_FLAT_FIELDS)]
