"""Column profiles and diagnosis of raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tinderbox.schemas import ddl


def _unpivot_row(row: DataFrame, columns: list[str], name: str, fields: dict[str, str]) -> DataFrame:
    """One wide aggregate row -> one row per column; `fields` maps output to name suffix."""
    entries = [
        F.struct(F.lit(c).alias(name), *[F.col(f"{c}__{s}").alias(o) for o, s in fields.items()])
        for c in columns
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def null_percentages(df: DataFrame) -> DataFrame:
    """Share of NULLs per column in one pass, most incomplete column first."""
    pct = [
        (F.sum(F.col(c).isNull().cast("bigint")) * 100.0 / F.count(F.lit(1))).alias(f"{c}__p")
        for c in df.columns
    ]
    table = _unpivot_row(df.agg(*pct), df.columns, "column", {"pct_nulls": "p"})
    return table.orderBy(F.col("pct_nulls").desc(), "column")


def log_column(df: DataFrame, column: str) -> DataFrame:
    """Replace a heavy-tailed count by its logarithm before profiling."""
    return df.withColumn(f"log_{column}", F.ln(column)).drop(column)


def profile(df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Counts, range, moments and approximate distinct values and quartiles per column.

    All sketches merge, so one pass with map-side partial aggregation is enough. Array, map
    and struct columns are left out.
    """
    simple = [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    ]
    aggs = []
    for c in simple:
        col = F.col(c)
        number = isinstance(df.schema[c].dataType, T.NumericType)
        value = col.cast("double") if number else F.lit(None).cast("double")
        text = col.cast("string")
        aggs += [
            F.count(col).alias(f"{c}__n"),
            F.count(F.when(col.isNull(), 1)).alias(f"{c}__nulls"),
            F.approx_count_distinct(col, rsd).alias(f"{c}__distinct"),
            F.min(F.length(text)).alias(f"{c}__minlen"),
            F.max(F.length(text)).alias(f"{c}__maxlen"),
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
            F.avg(value).alias(f"{c}__mean"),
            F.stddev_samp(value).alias(f"{c}__std"),
            F.percentile_approx(value, [0.25, 0.5, 0.75], 10000).alias(f"{c}__q"),
        ]
    names = {
        "n": "n", "nulls": "nulls", "approx_distinct": "distinct", "min_length": "minlen",
        "max_length": "maxlen", "min": "min", "max": "max", "mean": "mean", "std": "std",
        "q25": "q1", "q50": "q2", "q75": "q3",
    }
    row = df.agg(*aggs)
    quartiles = {
        f"{c}__q{i + 1}": F.get(f"{c}__q", F.lit(i)) for c in simple for i in range(3)
    }
    return _unpivot_row(row.withColumns(quartiles), simple, "column", names)


def faulty_rows(lines: DataFrame, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Raw lines that do not fit the schema (bad number, overflow, missing or extra fields)."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {
        "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record",
    }
    parsed = lines.withColumn("row", F.from_csv("value", ddl(marked), options))
    return parsed.where(F.col("row._corrupt_record").isNotNull()).drop("row")


def field_count_histogram(lines: DataFrame, group: str | None = None, sep: str = "\t") -> DataFrame:
    """How many lines have how many fields, per file if `group` names it."""
    keys = ([F.col(group)] if group else []) + [F.size(F.split("value", sep)).alias("n_fields")]
    return lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"))
