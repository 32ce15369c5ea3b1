"""Code -> description enrichment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_codes(dim: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """First non-null description per code, in file order.

    Keeping the dictionary unique keeps every enrichment row-preserving.
    """
    first = F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(position)))
    return dim.where(F.col(key).isNotNull()).groupBy(key).agg(first.alias(value))


def target_name(code_col: str, value: str) -> str:
    """Default name of a description column."""
    if "_code" in code_col:
        return code_col.replace("_code", "_" + value.rsplit("_", 1)[-1])
    return f"{code_col}_desc"


# (dictionary, code column, its key, its description, target column or None for the default)
Lookup = tuple[DataFrame, str, str, str, str | None]


def describe_all(df: DataFrame, lookups: Iterable[Lookup]) -> DataFrame:
    """Left joins of one description column each; existing target columns are replaced.

    Grouping a dictionary by its code keeps the join row-preserving whatever the dictionary
    holds, and lets the optimizer drop a lookup when nobody reads its target.
    """
    joined, added = df, {}
    for i, (dim, code_col, key, value, target) in enumerate(lookups):
        side = dim.groupBy(F.col(key).alias(f"__k{i}")).agg(F.min(value).alias(f"__v{i}"))
        joined = joined.join(side, F.col(code_col) == F.col(f"__k{i}"), "left")
        added[target or target_name(code_col, value)] = F.col(f"__v{i}")
    kept = [F.col(c) for c in df.columns if c not in added]
    return joined.select(*kept, *[c.alias(name) for name, c in added.items()])


def describe(
    df: DataFrame,
    dim: DataFrame,
    code_col: str,
    key: str,
    value: str,
    target: str | None = None,
) -> DataFrame:
    """One lookup of `describe_all`."""
    return describe_all(df, [(dim, code_col, key, value, target)])
