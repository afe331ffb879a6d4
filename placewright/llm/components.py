"""Connected components of links between rows, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewright.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the label is the least node reachable.

    Alternates the large-star and small-star steps until the links are stars: every node has one link, to a node that
    has none.  Each step is an aggregation and a join by node, and the links are written after each round, so the plan
    stays short and nothing visits the driver.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    while not _are_stars(edges):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the least neighbours are written too: a join of two tables can be split where a node has very many links
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = materialize(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"), "large")
        under = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "under")
        small = large.join(under, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = materialize(small.union(under.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())


def _are_stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("v", F.lit(0), F.lit(1)))
    by = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return by.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty()
