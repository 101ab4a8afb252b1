"""Connected components by alternating stars (Kiveris et al., 2014), in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.sources.scratch import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours link to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return linked.unionByName(least.select("a", F.col("least").alias("b")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link at most to a smaller node, and that one has none."""
    double = edges.groupBy("a").count().where("count > 1").select("a")
    inner = edges.join(edges.select(F.col("b").alias("root")), F.col("a") == F.col("root"), "left_semi").select("a")
    return double.unionByName(inner).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Links (a, b) to stars (a, b): each node but the least of its component, with that least node.

    Every iteration is written to the shared folder, so lineage stays short. Nodes of any degree are
    met by aggregates of one row per node; no neighbour list is gathered.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    while True:
        large = _large_star(edges).where("a <> b")
        edges = stored(_small_star(large).where("a <> b").distinct(), "stars")
        if _are_stars(edges):
            return edges
