"""Connected components by alternating star contractions, every round a shuffle of the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: those above a node (large star), or those up to it (small star).

    Minima are written as a table before the join: Spark splits a hub's rows only if no aggregate is in the way.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = materialize(least, "least")
    met = both.join(least, "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of an edge of (a, b)."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = materialize(pairs, "links"), None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        links = materialize(_stars(materialize(_stars(links, True), "links"), False), "links")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
