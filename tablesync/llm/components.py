"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.frames import written


def _checksum(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id in ``a`` or ``b``.

    Rounds of large-star and small-star: all larger neighbours of an id, then
    all smaller ones, are tied to the smallest neighbour, until nothing changes.
    Every round is written, so lineage stays short. A hub's neighbours meet its
    minimum in a join of two plain scans, which Spark splits.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while (now := _checksum(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = written(least.select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct())
        least = written(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        edges = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots.distinct())
