"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut


def _least(links: DataFrame, key: str, other: str) -> DataFrame:
    """Per ``key`` the least of itself and its ``other`` ends."""
    return links.groupBy(key).agg(F.min(other).alias("m")).select(
        F.col(key).alias("node"), F.least("m", key).alias("least"))


def components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the least node of its component.

    Each round is a large star (greater neighbours move to the least
    neighbour) and a small star (a node and its smaller neighbours move to the
    least of them), until nothing changes: a forest of stars. Neighbour lists
    are never gathered, only their minimum, and each round is written to the
    shared folder.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = cut(spark, links.select(high.alias("u"), low.alias("v")).where("u <> v").distinct(), "links")
    done = edges.isEmpty()
    while not done:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both, "u", "v")
        large = both.where("v > u").join(least, F.col("u") == F.col("node")).select(
            F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.where("u <> v").distinct()
        small_least = _least(large, "u", "v")
        small = large.join(small_least, F.col("u") == F.col("node")).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("least").alias("v")))).alias("e")).select("e.*")
        edges = cut(spark, small.where("u <> v").distinct(), "star-round")
        # stars: one edge for each node that has any, and none of those is a root
        n, nodes = edges.agg(F.count("*"), F.count_distinct("u")).first()
        heads = edges.select(F.col("v").alias("head")).distinct()
        done = n == nodes and edges.join(heads, F.col("u") == F.col("head"), "left_semi").isEmpty()
    roots = edges.groupBy("v").agg(F.lit(1).alias("one")).select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
