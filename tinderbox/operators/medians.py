"""Exact medians that never gather a group in one place.

`median()` keeps every value of a group in one task's memory, which a hot zone breaks.
Here equal values are counted first (map-side), the counts are summed per cell of the value
axis, the cell that holds the middle rank is found, and only that cell is ordered. A mergeable sketch sets the
cells of large groups; the selection stays exact wherever the edges lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tinderbox.operators.joins import join_null_safe

CELLS = 256
SMALL = 4096  # distinct values that may be ordered at once
SKETCH = 400  # size of the sketch: its ranks are good to about one in a hundred
SALTS = 32


def value_counts(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows (keys, measure, value, n), one per distinct non-null value.

    An exploded array rather than `unpivot`, whose plan Spark does not recognize as the same
    when it meets it twice; this one is shuffled once and reused.
    """
    pairs = [
        F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value")) for v in values
    ]
    long = df.select(*keys, F.explode(F.array(*pairs)).alias("p")).select(*keys, "p.*")
    usable = long.where(F.col("value").isNotNull())
    return usable.groupBy(*keys, "measure", "value").agg(F.count(F.lit(1)).alias("n"))


def _salted(groups: DataFrame) -> DataFrame:
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def cell_edges(salted: DataFrame, ids: list[str], cells: int, small: int) -> DataFrame:
    """(ids, edges) of groups of more than `small` distinct values: quantiles of a KLL sketch that cut the group's
    values into about `cells` parts of like number, however they are distributed. Only those groups are sketched."""
    number = F.when(~F.isnan("value"), F.col("value"))
    large = salted.groupBy(*ids).agg(F.count(number).alias("rows")).where(F.col("rows") > small).drop("rows")
    held = join_null_safe(salted, _salted(large), [*ids, "salt"], "inner")
    ranks = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    sketched = held.groupBy(*ids).agg(F.kll_sketch_agg_double(number, F.lit(SKETCH)).alias("sketch"))
    return sketched.select(*ids, F.array_distinct(F.kll_sketch_get_quantile_double("sketch", ranks)).alias("edges"))


def _cells(counts: DataFrame, ids: list[str], cells: int, small: int) -> DataFrame:
    """Add `cell`: how many edges of its group lie below a value. Groups without edges are one cell.

    Groups are joined by their key and a salt, so that the rows of one large group are not one join key.
    """
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int"))
    edges = _salted(cell_edges(salted, ids, cells, small))
    joined = join_null_safe(salted, edges, [*ids, "salt"], "left").drop("salt")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(cells.bit_length()))])

    def search(value):
        further = lambda at, step: F.get("edges", at + step - 1) < value
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(further(at, step), at + step).otherwise(at))

    cell = F.when(F.isnan("value"), F.lit(cells)).when(F.col("edges").isNull(), F.lit(0)).otherwise(search(F.col("value")))
    return joined.select(*ids, "value", "n", cell.alias("cell"))


def medians_of_counts(
    counts: DataFrame, keys: list[str], values: list[str], cell_width: float | None = None, cells: int = CELLS, small: int = SMALL
) -> DataFrame:
    """Interpolated median per key from `value_counts` rows; one column per measure.

    NaN is the largest value, as in `median`. The cells of a group follow its values; `cell_width` asks for cells of that
    width instead.
    """
    ids = [*keys, "measure"]
    if cell_width is None:
        counts = _cells(counts, ids, cells, small)
    else:
        cell = F.when(F.isnan("value"), F.lit(2**62)).otherwise(F.floor(F.col("value") / cell_width))
        counts = counts.select(*ids, "value", "n", cell.alias("cell"))

    along = Window.partitionBy(*ids).orderBy("cell")
    cells = (
        counts.groupBy(*ids, "cell")
        .agg(F.sum("n").alias("cell_n"))
        .withColumn("below", F.sum("cell_n").over(along) - F.col("cell_n"))
        .withColumn("total", F.sum("cell_n").over(Window.partitionBy(*ids)))
        # zero-based ranks of the two middle values (equal for an odd total)
        .withColumn("low", F.expr("(total - 1) div 2"))
        .withColumn("high", F.expr("total div 2"))
        .where("low < below + cell_n and high >= below")
    )

    inside = Window.partitionBy(*ids, "cell").orderBy("value")
    ranked = (
        join_null_safe(counts, cells, [*ids, "cell"], "inner")
        .withColumn("upto", F.col("below") + F.sum("n").over(inside))
        .withColumn("from", F.col("upto") - F.col("n"))
    )

    def at(rank: str, measure: str):
        hit = (F.col("measure") == measure) & (F.col("from") <= F.col(rank))
        return F.max(F.when(hit & (F.col(rank) < F.col("upto")), F.col("value")))

    return ranked.groupBy(*keys).agg(
        *[((at("low", v) + at("high", v)) / 2).alias(v) for v in values]
    )


def exact_medians(df: DataFrame, keys: list[str], values: list[str], cell_width: float | None = None) -> DataFrame:
    """Median of each column in `values` per `keys`; groups without values have no row."""
    return medians_of_counts(value_counts(df, keys, values), keys, values, cell_width)
