"""Connected components of links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.frames import written


def connected(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` of every node in ``links`` (``a, b``): the smallest
    node reachable. Large-star and small-star rounds in turn; each round is a
    smallest neighbour per node (combined before the shuffle) and a join back,
    and is written to the shared folder. Isolated nodes have no row."""
    edges = written(_directed(links), label)
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")))
        edges = _directed(large)
        down = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = (edges.join(down, "a")
                 .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
                         .alias("a"), F.col("m").alias("b")))
        edges = written(_directed(small), label)
        row = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row == before:
            break
        before = row
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b"), F.col("b"))).distinct()


def _directed(links: DataFrame) -> DataFrame:
    return (links.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
