"""Connected components of links between numbered rows, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hearthwatt.llm.frames import stored


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    return both.join(least, "a").where("b > a AND b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame, a: str, b: str, rounds: int | None = None) -> DataFrame:
    """``node, component`` for every node of ``links`` that is not the smallest of its component.

    With ``rounds`` no more are run: then nodes of one name are connected still, but a component may have several names.
    Nulls and links of a node to itself are ignored. Every round ends in the shared folder; the sums of two rounds tell
    when nothing moves any more. A node with many neighbours is summed up before the shuffle and joined with one row.
    """
    low, high = F.least(a, b).cast("long"), F.greatest(a, b).cast("long")
    known = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    edges, before = stored(links.where(known).select(high.alias("a"), low.alias("b")).distinct(), "links"), None
    while True:
        edges = stored(_small(_large(edges).distinct()).distinct(), "stars")
        if rounds is not None:
            rounds -= 1
            if rounds <= 0:
                return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
            continue
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
