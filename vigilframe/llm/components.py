"""Connected components of an edge table: alternating stars, each round a few joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.operators.lineage import landed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its lesser neighbours are tied to the least of them.  Edges come with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(others).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges(a, b)``; root is the least node that links reach.

    Nulls and loops are left out; edges may repeat and have any direction.  Rounds grow with the
    logarithm of the longest chain; a node of many links is summed up before it moves.  Every
    round is stored, and only its number of rows and a checksum reach the driver.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = landed(pairs), None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == before or mark.n == 0:
            break
        before = mark
        now = landed(_small_star(_large_star(now)))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
