"""Connected components by alternating star contraction, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize, release


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """Smallest member of the component of each node, as rows (node, root).

    ``edges`` has columns ``a`` and ``b`` of one orderable type; loops, repeated edges and nulls
    are ignored, and nodes without an edge to another are not returned. A round lets every
    node's larger neighbours (and then its smaller ones) point to its smallest neighbour, with
    minima aggregated before the shuffle; star-shaped input takes two rounds, chains a number
    of rounds that grows with the logarithm of their length. Only a row count and a hash sum of
    each round reach the driver.
    """
    spark = edges.sparkSession
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, path = materialize(edges, "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.join(least, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (small.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        done, last = path, state
        edges, path = materialize(small, "edges")
        state = _state(edges)
        release(spark, done)
        if state == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
