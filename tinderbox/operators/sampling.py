"""Samples of lines and rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tinderbox.operators.joins import join_null_safe


def sample_fraction(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Bernoulli sample with a repeatable seed."""
    return df.sample(fraction=fraction, seed=seed)


def sample_exact(
    df: DataFrame, group: str, key: str, fraction: float, seed: int = 0, digits: int = 3
) -> DataFrame:
    """Exactly floor(n * fraction) rows of each group: those with the smallest key hashes.

    Hash prefixes cut a group into cells. Cells wholly below the cut are kept as they are and
    only the cell that crosses it is ranked, so a group is never ordered as a whole.
    """
    hashed = df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))))
    hashed = hashed.withColumn("__cell", F.substring("__h", 1, digits))

    per_group = Window.partitionBy(group)
    cells = (
        hashed.groupBy(group, "__cell")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(per_group.orderBy("__cell")) - F.col("__n"))
        .withColumn("__quota", F.floor(F.sum("__n").over(per_group) * F.lit(fraction)))
        .where("__before < __quota")
        .withColumn("__need", F.least(F.col("__n"), F.col("__quota") - F.col("__before")))
    )
    near = join_null_safe(hashed, cells, [group, "__cell"], "inner")
    rank = F.row_number().over(Window.partitionBy(group, "__cell").orderBy("__h", key))
    return near.withColumn("__rank", rank).where("__rank <= __need").select(*df.columns)
