"""Value frequencies and running totals over them.

A running total over all values would need one ordered partition. Values with the same count
are split by hash prefix instead: totals per (count, prefix) cell give each cell its offset,
and rows are ordered inside their cell only. The one unpartitioned window sees the distinct
counts, of which N rows have at most sqrt(2 N).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_LABEL = "__NULL__"  # fixed value
BUCKETS = 1 << 16


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows (value, cnt) with NULL counted under its own label."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(NULL_LABEL))
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("cnt"))


def bucket_totals(df: DataFrame, column: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, total): how many rows fall into each hash bucket of the value. Totals add up over parts of the
    rows, and a bucket's total bounds the count of every value in it."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(NULL_LABEL))
    return df.groupBy(F.pmod(F.xxhash64(value), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("total"))


def heavy_hitters(df: DataFrame, column: str, top: int, buckets: int = BUCKETS, totals: DataFrame | None = None) -> DataFrame:
    """Rows (value, cnt, pct) of the `top` most frequent values, exactly; ties by value, NULL under its own label.

    Totals by hash bucket propose: only values in the heaviest buckets are counted one by one. They are the answer if the
    last of them is more frequent than any bucket left out is heavy. If not, as with many values of like
    frequency, all values are counted. So what is usually shuffled is the buckets and the values of a few of them. `totals` are stored
    `bucket_totals` of the same rows, with which the first pass is saved.
    """
    totals = bucket_totals(df, column, buckets) if totals is None else totals
    heaviest = totals.orderBy(F.col("total").desc(), "bucket").limit(4 * top + 1).collect()
    whole = totals.agg(F.sum("total")).first()[0] or 0
    chosen, bound = [r["bucket"] for r in heaviest[: 4 * top]], heaviest[-1]["total"] if len(heaviest) > 4 * top else 0
    value = F.coalesce(F.col(column).cast("string"), F.lit(NULL_LABEL))

    def first(rows: DataFrame) -> DataFrame:
        return value_frequencies(rows, column).orderBy(F.col("cnt").desc(), "value").limit(top)

    proposed = first(df.where(F.pmod(F.xxhash64(value), F.lit(buckets)).isin(chosen)))
    if bound:
        counts = [r["cnt"] for r in proposed.collect()]  # at most `top`
        if len(counts) < top or counts[-1] <= bound:
            proposed = first(df)
    return proposed.select("value", "cnt", (F.col("cnt") * 100.0 / F.lit(max(whole, 1))).alias("pct"))


def tie_prefix(key: Column, digits: int) -> Column:
    return F.substring(F.md5(key), 1, digits)


def running_total(
    counts: DataFrame, key: str, count: str = "cnt", digits: int = 3
) -> DataFrame:
    """Add `cum_cnt` and `position` in order of (count desc, hash prefix of key, key)."""
    cells = counts.withColumn("tie", tie_prefix(F.col(key), digits))
    per_cell = cells.groupBy(count, "tie").agg(F.count(F.lit(1)).alias("members"))
    in_count = Window.partitionBy(count).orderBy("tie")
    per_cell = per_cell.withColumn("members_before", F.sum("members").over(in_count) - F.col("members"))

    per_count = counts.groupBy(count).agg(F.count(F.lit(1)).alias("members"))
    upto = Window.orderBy(F.col(count).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mass = F.col("members") * F.col(count)
    per_count = per_count.select(
        count,
        (F.sum("members").over(upto) - F.col("members")).alias("members_above"),
        (F.sum(mass).over(upto) - mass).alias("mass_above"),
    )
    offsets = per_cell.join(per_count, count).select(
        count, "tie", "members_before", "members_above", "mass_above"
    )
    inside = F.row_number().over(Window.partitionBy(count, "tie").orderBy(key))
    rank_in_count = F.col("members_before") + inside
    return cells.join(offsets, [count, "tie"]).select(
        *[F.col(c) for c in counts.columns],
        (F.col("mass_above") + rank_in_count * F.col(count)).alias("cum_cnt"),
        (F.col("members_above") + rank_in_count).alias("position"),
    )


def cumulative_share(counts: DataFrame, key: str, count: str = "cnt") -> DataFrame:
    """Share and running share of the total, most frequent first."""
    total = counts.agg(F.sum(count)).scalar()
    return running_total(counts, key, count).select(
        key,
        count,
        (F.col(count) / total).alias("fraction"),
        (F.col("cum_cnt") / total).alias("fraction_cumsum"),
    )


def top_frequent(
    df: DataFrame, column: str, top: int | None = None, total_pct: float | None = None
) -> DataFrame:
    """Most frequent values in percent, cut by number or by covered percentage.

    One extra row sums up the rest: `*OTHER* (n distinct values)`.
    """
    if (top is None) == (total_pct is None):
        raise ValueError("give either top or total_pct")
    freq = value_frequencies(df, column)
    total = freq.agg(F.sum("cnt")).scalar()
    if top is not None:
        kept = freq.orderBy(F.col("cnt").desc(), F.col("value")).limit(top)
    else:
        ordered = running_total(freq, "value")
        # a value is kept while the values before it cover less than the wanted share
        before = (F.col("cum_cnt") - F.col("cnt")) * 100.0
        kept = ordered.where(before < F.lit(float(total_pct)) * total).select("value", "cnt")

    kept_sum = kept.agg(F.coalesce(F.sum("cnt"), F.lit(0))).scalar()
    kept_n = kept.agg(F.count(F.lit(1))).scalar()
    rest_n = (F.col("n") - kept_n).cast("string")
    rest = freq.agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("s")).select(
        F.concat(F.lit("*OTHER* ("), rest_n, F.lit(" distinct values)")).alias("value"),
        ((F.col("s") - kept_sum) * 100.0 / F.col("s")).alias("pct"),
    )
    return kept.select("value", (F.col("cnt") * 100.0 / total).alias("pct")).unionByName(rest)
