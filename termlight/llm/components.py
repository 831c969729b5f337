"""Connected components of an edge table by alternating stars.

Each round links the larger neighbours of a node to its smallest neighbour, then the same for the
smaller ones, until every component is a star around its smallest node. Rounds are logarithmic in
practice, and none is made of what are stars already. Each is two shuffles of narrow rows with partial aggregation; joins of a node with many
neighbours are dealt anew by adaptive execution. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlight.session import cut_lineage


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no smaller end: then each lies at the root of its component."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up + down > 1 AND up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` that is not itself the smallest of its component."""
    apart = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    current = cut_lineage(apart.distinct(), "edges")
    while not _stars(current):
        current = cut_lineage(_round(current), "edges")
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    small = large.groupBy("hi").agg(F.min("lo").alias("m"))
    hooked = large.join(small, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return hooked.unionByName(small.select("hi", F.col("m").alias("lo"))).distinct()
