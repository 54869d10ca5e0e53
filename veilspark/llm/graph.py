"""Connected components as Spark jobs; links never reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _mark(edges: DataFrame):
    """Number of rows and a sum of their hashes: equal for equal edge sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Alternates two steps until nothing changes, each one combinable minimum per node and a
    join on the node: every node passes the smallest neighbour to its larger neighbours,
    then to its smaller ones. A hub costs rows in proportion to its links, which AQE may
    split; a step never makes more rows than there are links.
    """
    edges = stored(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = (both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .where("u != v").distinct())
        larger = stored(larger, "larger")
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = stored(smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "smaller")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
