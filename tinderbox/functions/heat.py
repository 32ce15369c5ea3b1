"""The three conflict-heat formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared(score: Column) -> Column:
    """0 for cooperative events, score squared for conflicts, NULL for an unknown score."""
    return F.when(score >= 0, F.lit(0.0)).otherwise(score * score)


def mention_weighted(score: Column, mentions: Column) -> Column:
    return F.log1p(mentions) * -score


def tone_blend(score: Column, tone: Column, mentions: Column) -> Column:
    return (score + tone) / 2 * mentions
