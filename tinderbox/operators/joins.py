"""Equi joins shared by the other operators.

No join carries a broadcast hint: Spark broadcasts a side when its measured size is below
`spark.sql.autoBroadcastJoinThreshold` and otherwise sorts and merges, where adaptive
execution splits partitions that a hot key has made too large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tinderbox.operators.sift import EXPECTED, sifted


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi join on `keys` where NULL equals NULL; each key appears once in the result."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"__{k}" for k in keys])


def not_yet_done(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `work` whose composite key is absent from `done`."""
    return work.join(done.select(*keys), keys, "left_anti")


def pending(work: DataFrame, done: DataFrame, key: str, needs: str) -> DataFrame:
    """Unfinished rows that have their input."""
    return not_yet_done(work.where(F.col(needs).isNotNull()), done, [key])


def prefer_success(responses: DataFrame, key: str, success: str, tie: str) -> DataFrame:
    """One response per key: a successful one if there is any, then the one with the smallest `tie`, then the one whose
    columns have the smallest hash; rows that are still equal are equal in all columns.

    Responses compete before the shuffle, so that one per key and task moves.
    """
    failed = F.coalesce(~F.col(success), F.lit(True))
    rank = F.struct(failed, F.col(tie), F.xxhash64(*[F.col(f"`{c}`") for c in responses.columns]))
    rows = responses.select(F.col(key).alias("__key"), rank.alias("__rank"), F.struct("*").alias("__row"))
    return rows.groupBy("__key").agg(F.min_by("__row", "__rank").alias("__row")).select("__row.*")


def cached_responses(
    wanted: DataFrame, responses: DataFrame, key: str, success: str, tie: str, expected: int = EXPECTED
) -> DataFrame:
    """Attach the best known response to each wanted row; `is_hit` marks the found ones.

    The store is sifted where it is scanned, so bodies nobody asked for are not shuffled; about `expected` keys
    are wanted.
    """
    best = prefer_success(sifted(responses, key, wanted, expected), key, success, tie).withColumn("is_hit", F.lit(True))
    return wanted.join(best, key, "left").withColumn(
        "is_hit", F.coalesce("is_hit", F.lit(False))
    )


def cached_vectors(
    rows: DataFrame, cache: DataFrame, key: str, vector: str, dim: int
) -> DataFrame:
    """Look up a vector per key; an unknown key gets the zero vector. Vectors nobody asked for stop at the scan."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return rows.join(sifted(cache.select(key, vector), key, rows), key, "left").withColumn(
        vector, F.coalesce(vector, zero)
    )
