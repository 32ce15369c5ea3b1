"""Exact duplicates by content sort, in DataFrame functions only.

Sampled splitters cut the order of the texts into buckets of like weight, every bucket is sorted (externally, by
Spark), and each row is compared in full with its neighbour. The order is: first bytes of the text, SHA-256 of the text,
the text itself, a number of the row. Splitters hold the first two and the row's number, so they are short however
long the texts are, and a text with any number of copies is cut into as many buckets as its weight asks
for. A run of equal texts that leaves its bucket is joined with the next bucket's first run after a full
comparison of the two rows at the boundary.

Texts are shuffled once. What is written afterwards holds no texts but two of each bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize

HEAD_BYTES = 32
OVERSAMPLE = 16
ROW_WEIGHT = 64
MOST_BUCKETS = 65_536  # bounds the splitters (about 10 MB), not the rows of a bucket
KEEP = ("smallest", "largest")


def _marked(rows: DataFrame) -> DataFrame:
    """`mark` (first bytes and digest) orders texts, `place` orders rows. Both compare bytewise."""
    rows = rows.withColumn("mark", F.concat_ws(" ", F.hex(F.substring("key", 1, HEAD_BYTES)), F.sha2("key", 256)))
    return rows.withColumn("place", F.concat_ws(" ", "mark", F.lpad(F.col("row").cast("string"), 20, "0")))


def splitters(rows: DataFrame, buckets: int) -> list[str]:
    """At most `buckets` - 1 places that cut `rows` (key, row) into buckets of like weight, from a sample of
    about OVERSAMPLE rows a bucket."""
    count = rows.count()
    if count == 0 or buckets < 2:
        return []
    sample = _marked(rows.sample(min(1.0, OVERSAMPLE * buckets / count), 7))
    weighed = sample.select("place", (F.octet_length("key") + ROW_WEIGHT).alias("weight"))
    upto = F.sum("weight").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    every = F.sum("weight").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    cuts = weighed.select("place", F.floor(F.coalesce(upto, F.lit(0)) * buckets / every).alias("bucket"))
    return sorted(r[0] for r in cuts.groupBy("bucket").agg(F.min("place")).where("bucket > 0").drop("bucket").collect())


def bucket_of(place: Column, cuts: list[str]) -> Column:
    """How many of the sorted `cuts` are at or before the place: a binary search."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    table = F.array(*[F.lit(c) for c in cuts])

    def search(x: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= x, at + step).otherwise(at))

    # Bound to a variable, the place is computed once, not in each step.
    return F.transform(F.array(place), search)[0]


def _sorted_runs(docs: DataFrame, keep: str, normalise: Callable[[Column], Column] | None, buckets: int | None, more: list[Column]) -> DataFrame:
    """Rows with their bucket, their run of equal texts in it, and the run's size and best row; `edge` is the text of
    a bucket's first and last row."""
    spark = docs.sparkSession
    n = min(MOST_BUCKETS, buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = (normalise(text) if normalise else text).cast("binary")
    rows = docs.select(F.col("doc_id").alias("id"), key.alias("key"), *more).withColumn("row", F.monotonically_increasing_id())
    cuts = splitters(rows.select("key", "row"), n)
    placed = _marked(rows).withColumn("bucket", bucket_of(F.col("place"), cuts)).drop("place")

    order = Window.partitionBy("bucket").orderBy("mark", "key", "row")
    before, after = F.lag("key").over(order), F.lead("row").over(order)
    met = placed.withColumn("fresh", F.coalesce(before != F.col("key"), F.lit(True))).withColumn("first", before.isNull()).withColumn("last", after.isNull())
    slim = met.withColumn("edge", F.when(F.col("first") | F.col("last"), F.col("key"))).drop("key")
    run = F.sum(F.col("fresh").cast("long")).over(Window.partitionBy("bucket").orderBy("mark", "row").rowsBetween(Window.unboundedPreceding, 0))
    numbered = slim.withColumn("run", run)

    # Rows without an id come after all others; of equal ids the first row is taken.
    same = Window.partitionBy("bucket", "run")
    if keep == "smallest":
        best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).over(same)
    else:
        best = F.max(F.struct(F.col("id").isNotNull().alias("some"), "id", (-F.col("row")).alias("row"))).over(same)
    extra = [c for c in placed.columns if c not in ("id", "key", "row", "mark", "bucket")]
    return numbered.withColumn("size", F.count(F.lit(1)).over(same)).withColumn("best", best).select(
        "id", "row", F.substring("mark", -64, 64).alias("sha"), "bucket", "run", "first", "last", "edge", "size", "best", *extra
    )


def _spanning(held: DataFrame, keep: str) -> DataFrame:
    """bucket, run, all_size and all_best of the runs that go on in a neighbouring bucket."""
    heads = held.where("first").select("bucket", F.col("edge").alias("head"), F.col("size").alias("head_size"), F.col("best").alias("head_best"))
    tails = held.where("last").select("bucket", F.col("run").alias("runs"), F.col("edge").alias("tail"), "size", "best")
    line = Window.orderBy("bucket")
    near = tails.select("bucket", "runs").withColumn("previous", F.lag("bucket").over(line))
    met = near.join(heads, "bucket").join(tails.select(F.col("bucket").alias("previous"), "tail"), "previous", "left")
    joined = met.withColumn("linked", F.coalesce(F.col("head") == F.col("tail"), F.lit(False))).drop("head", "tail", "previous")
    # The bucket in which the run that ends this bucket began.
    opens = F.when(~(F.col("linked") & (F.col("runs") == 1)), F.col("bucket"))
    chained = joined.withColumn("origin", F.last(opens, True).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    chained = chained.withColumn("origin", F.lag("origin").over(line)).where("linked")
    later = chained.select("origin", "bucket", F.lit(1).cast("long").alias("run"), F.col("head_size").alias("size"), F.col("head_best").alias("best"))
    began = tails.join(chained.select(F.col("origin").alias("bucket")).distinct(), "bucket").select(
        F.col("bucket").alias("origin"), "bucket", F.col("runs").alias("run"), "size", "best"
    )
    parts = later.unionByName(began)
    best = F.min("best") if keep == "smallest" else F.max("best")
    totals = parts.groupBy("origin").agg(F.sum("size").alias("all_size"), best.alias("all_best"))
    return parts.join(totals, "origin").select("bucket", "run", "all_size", "all_best")


def _judged(docs: DataFrame, keep: str, normalise: Callable[[Column], Column] | None, buckets: int | None, more: list[Column]) -> DataFrame:
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}, not {keep!r}")
    held = materialize(_sorted_runs(docs, keep, normalise, buckets, more), "runs")
    spans = materialize(_spanning(held, keep), "spans")
    best = F.coalesce("all_best", "best")
    return (
        held.drop("first", "last", "edge").join(spans, ["bucket", "run"], "left")
        .withColumn("keep_id", best["id"]).withColumn("kept", F.abs(best["row"]) == F.col("row"))
        .withColumn("group_size", F.coalesce("all_size", "size"))
    )


def exact_duplicates(
    docs: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] | None = None, buckets: int | None = None
) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id (the id that stays), group_size, kept, text_sha256.

    Texts are equal if their UTF-8 bytes are, after `normalise` (default: no change); null counts as
    empty. Of equal texts the row of the smallest (or largest) id stays; ids may be of any type that can be
    ordered. Exactly one row of each group stays: a row without an id only if none has one (keep_id is
    null then), and of rows that repeat the id that stays, one. Texts of any length, also empty ones, are
    compared whole. An empty table gives no rows. Other columns are not read.
    """
    out = _judged(docs, keep, normalise, buckets, [])
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(
    docs: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] | None = None, buckets: int | None = None
) -> DataFrame:
    """The rows that `exact_duplicates` keeps, with all their columns, whatever these are named."""
    whole = F.struct(*[docs[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("whole")
    out = _judged(docs, keep, normalise, buckets, [whole]).where("kept")
    return out.select(*[F.col("whole")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns)])
