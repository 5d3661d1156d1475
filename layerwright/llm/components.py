"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import removed, stored


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for every id that occurs in a link; ``component`` is the smallest id reachable.

    Alternating star contractions: each round hangs the neighbours of every id onto its smallest neighbour, first
    the larger ones, then the smaller ones.  The number of rounds grows with the logarithm of the number of ids.
    Minima are combined before the shuffle, so an id with very many links sends one row per task.  Links with a
    null end and links from an id to itself count for nothing; no links give an empty result.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, path = stored(edges, "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        after, after_path = stored(small.where("u <> v").distinct(), "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        removed(spark, path)
        edges, path = after, after_path
        if mark == before:
            break
        before = mark
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
