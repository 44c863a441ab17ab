"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (u, v: long) can reach.

    Alternating star contractions: every node's larger neighbours are hung below its smallest
    neighbour, then its smaller ones; after a number of rounds that grows with the logarithm of the
    longest path the graph is a set of stars.  Each round is written, so that lost executors cost
    one round at most.  Only counts come to the driver.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stored(small)
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.count_if(F.col("u") < 0)).first()
        if mark == before:
            break
        before = mark
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
