"""Column profiles from stored sketches.

A day's profile is one row per column: counts, ranges, moments, a distinct-count sketch and a quantile sketch, each of which
merges. Profiles of any set of days come from their stored rows, of which there are columns times days, without a look at
the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tinderbox.sinks import storage, writers

DISTINCT = 12  # log2 of the sketch's size: distinct counts are good to about 2 %
QUANTILES = 400  # ranks are good to about 1 %
_LEFT_OUT = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)


def _one(name: str, kind: T.DataType) -> tuple[list, list[str]]:
    col = F.col(f"`{name}`")
    number = isinstance(kind, T.NumericType)
    value = col.cast("double") if number else F.lit(None).cast("double")
    text = col.cast("string")
    plain = F.when(~F.isnan(value), value)
    sketch = F.kll_sketch_agg_double(plain, F.lit(QUANTILES)) if number else F.lit(None).cast("binary")
    n = F.count(value)
    fields = {
        "n": F.count(col), "nulls": F.count_if(col.isNull()), "min_length": F.min(F.length(text)), "max_length": F.max(F.length(text)),
        "min": F.min(value), "max": F.max(value), "mean": F.avg(value), "spread": F.when(n > 0, F.var_pop(value) * n),
        "values": F.count(plain), "distinct": F.hll_sketch_agg(text, F.lit(DISTINCT)), "quantiles": sketch,
    }
    return [expr.alias(f"{name}__{field}") for field, expr in fields.items()], list(fields)


def day_profiles(df: DataFrame, day: str) -> DataFrame:
    """One row per day and column of `df`, in one pass. Array, map, struct and binary columns are left out, as is the
    day itself; a null day is a day. Dates, texts and the like have no range, moments or quartiles."""
    names = [f.name for f in df.schema.fields if f.name != day and not isinstance(f.dataType, _LEFT_OUT)]
    made = {c: _one(c, df.schema[c].dataType) for c in names}
    wide = df.groupBy(day).agg(*[a for aggs, _ in made.values() for a in aggs])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields]) for c, (_, fields) in made.items()]
    return wide.select(day, F.explode(F.array(*rows)).alias("r")).select(day, "r.*")


def merged(parts: DataFrame) -> DataFrame:
    """The profile of all rows behind `parts`: the columns of `quality.profile`.

    Counts, ranges and moments are exact up to rounding, distinct counts and quartiles as good as their sketches.
    """
    n = F.sum("values")
    mass = F.sum(F.col("mean") * F.col("values"))
    spread = F.sum("spread") + F.sum(F.col("mean") * F.col("mean") * F.col("values")) - mass * mass / n
    total = parts.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("approx_distinct"),
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.when(n > 0, mass / n).alias("mean"), F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1))).alias("std"),
        F.when(n > 0, F.kll_merge_agg_double(F.when(F.col("values") > 0, F.col("quantiles")))).alias("sketch"),
    )
    cut = F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    quartiles = total.withColumn("cut", cut)
    return quartiles.select(*[c for c in total.columns if c != "sketch"], *[F.get("cut", F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))])


def refresh_profiles(rows: DataFrame, path: str, day: str, days: list) -> None:
    """Replace the stored profiles of `days` by those of `rows`, which has only these days."""
    writers.replace_values(day_profiles(rows, day), path, day, days)


def profile_of(spark: SparkSession, path: str, condition=None) -> DataFrame:
    """The profile of the stored days that meet a condition on the day (all, without one)."""
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"no profiles at {path}")
    parts = spark.read.parquet(path)
    return merged(parts if condition is None else parts.where(condition))
