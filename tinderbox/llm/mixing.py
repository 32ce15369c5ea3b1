"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order. A document's virtual finish time is
the number of its source's words up to and including it, divided by the source's target; all
queues are merged by that time, and the mix ends where the total budget is spent. A source that
shall give more than it has goes through its queue again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tinderbox.llm.common import WORD, materialize

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MAX_REPEATS = 2
# A running total first sums cells of the order (hash prefixes of a queue, slices of virtual time),
# so only the rows inside one cell are sorted together.
HASH_DIGITS = 3
TIME_CELLS = 4096


def word_count(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size and target: the budget shared by weight, each target at most
    MAX_REPEATS times the source's size, the excess reshared by weight until nobody exceeds it.

    With sources in the order of (limit / weight), those that hit their limit come first: source i does
    if its limit is below its share of what the earlier ones left. One row per source goes through
    the window, never the documents.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(1))
    weights = F.array(*map(F.lit, WEIGHTS))
    return (
        sources.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(weights, F.col("rank") - F.floor((F.col("rank") - 1) / len(WEIGHTS)).cast("int") * len(WEIGHTS)))
        .withColumn("most", MAX_REPEATS * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(BUDGET_PERCENT / 100))
        .withColumn("all_weight", F.sum("weight").over(whole))
        .withColumn("before", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.col("all_weight") - F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("weight_left"))
        .withColumn("capped", F.col("ratio") <= F.col("level"))
        .withColumn("free_level", F.min(F.when(~F.col("capped"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(whole)["level"])
        .withColumn("target", F.when(F.col("capped"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("free_level")).cast("double"))
        .select("source", "source_size", "target")
    )


def running(df: DataFrame, key: str, cell: str, order: list[Column], amount: str, out: str) -> DataFrame:
    """Running total of `amount` per `key`, ordered by `cell`, then by `order`."""
    ahead = Window.partitionBy(key).orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = df.groupBy(key, cell).agg(F.sum(amount).alias("_sum"))
    sums = sums.withColumn("_ahead", F.sum("_sum").over(ahead) - F.col("_sum")).drop("_sum")
    inside = Window.partitionBy(key, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.join(sums, [key, cell]).withColumn(out, F.col("_ahead") + F.sum(amount).over(inside)).drop("_ahead")


def _lined(sized: DataFrame) -> DataFrame:
    """Rows of (queue, size, doc_id, ...) with their source's figures and `repeats`, how often the mix draws them."""
    targets = source_targets(sized).withColumn("queue", queue_key("source"))
    queued = (
        sized.withColumn("queue", queue_key("source"))
        .drop("source")
        .withColumn("draw", F.md5(F.concat_ws(":", F.lit("mix"), F.col("doc_id").cast("string"), F.col("size").cast("string"))))
        .withColumn("cell", F.substring("draw", 1, HASH_DIGITS))
    )
    order = [F.col("draw"), F.col("doc_id").asc_nulls_first()]
    lined = running(queued, "queue", "cell", order, "size", "upto").drop("cell")
    lined = materialize(lined.join(targets.drop("source"), "queue"), "mix-queues")

    def finish(repeat: int) -> Column:
        return (F.col("upto") + repeat * F.col("source_size")) / F.col("target")

    def offered(repeat: int) -> Column:
        begins = F.col("upto") + repeat * F.col("source_size") - F.col("size")
        return (F.col("target") > 0) & (F.col("size") > 0) & (begins < F.col("target"))

    turns = lined.select(
        F.lit(0).alias("all"), "queue", "draw", "doc_id", "size",
        F.explode(F.array_compact(F.array(*[F.when(offered(r), finish(r)) for r in range(MAX_REPEATS)]))).alias("finish"),
    ).withColumn("slice", F.least(F.floor(F.col("finish") * TIME_CELLS), F.lit(2 * TIME_CELLS)))
    place = ["finish", "queue", "draw", "doc_id"]
    merged = running(turns, "all", "slice", place, "size", "spent")
    budget = targets.agg(F.sum("target").alias("b")).first()["b"] or 0.0
    cut = merged.where(F.col("spent") <= budget).agg(F.max(F.struct(*place)).alias("cut")).first()["cut"]
    if cut is None:
        return lined.withColumn("repeats", F.lit(0))
    last = F.struct(*[F.lit(cut[c]).cast(turns.schema[c].dataType).alias(c) for c in place])
    drawn = [
        F.when(offered(r) & (F.struct(finish(r).alias("finish"), *place[1:]) <= last), 1).otherwise(0) for r in range(MAX_REPEATS)
    ]
    return lined.withColumn("repeats", sum(drawn[1:], drawn[0]))


def mix_sources(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken, the words that the mix takes
    of it (its size, once for each time it is drawn).

    A queue hands out a document while the words before it are below the source's target; the merged
    queues are cut before the first document with which the total would exceed the sum of targets.
    Shuffling and ties are settled by md5 of id and size, then id, so reruns agree. Null and empty
    texts have size 0 and take nothing; null ids are ids like others; null sources form one source,
    ordered last. Rows that repeat take places of their own. No rows give no rows. Extra columns are
    not read.
    """
    sized = materialize(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")),
        "mix-sizes",
    )
    taken = (F.col("size") * F.col("repeats")).cast("long").alias("taken")
    return _lined(sized).select("doc_id", "size", "source_size", "target", taken)


def draw_mix(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is drawn, with all its columns and no others.

    Documents meet their draws by a row number of the table, which has to be read the same way twice (a
    written one is), so neither repeated ids nor clashing names confuse them.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    numbered = docs.select(
        whole, "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    drawn = _lined(numbered.drop("doc")).where("repeats > 0").select("row", "repeats")
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats")))
    return numbered.join(drawn, "row").select("doc", copies.alias("copy")).select("doc.*")


def queue_key(source: str) -> Column:
    """A key without nulls, in the sources' own order, null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))
