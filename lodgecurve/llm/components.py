"""Connected components of an edge table, for graphs of any size and any shape of hub."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.operators.scale import join_measured, materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two columns ``a`` and ``b`` of one type).

    ``root`` is the smallest node of the component. Alternates two star rewrites until the edges
    are stars around the smallest nodes: every node hands its larger neighbours to its smallest
    neighbour, then its smaller neighbours (itself included) too. The smallest neighbours are an
    aggregation with map-side combine, written as a table of its own: it is broadcast if its files
    are small, else adaptive execution can split the partition of a hub. Every step ends in a table
    in the shared folder; the driver only sees a count. The number of steps grows with the logarithm
    of the longest path.
    """
    edge = F.when(F.col("a") > F.col("b"), F.struct("a", "b")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    e = edges.where(F.col("a") != F.col("b")).select(edge.alias("e")).select(F.col("e.a").alias("u"), F.col("e.b").alias("v")).distinct()
    e = materialise(e)
    while not _stars(e):
        e = materialise(_small_star(materialise(_large_star(e))))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _stars(e: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where(F.col("up") + F.col("down") > 1).isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return join_measured(both.where(F.col("v") > F.col("u")), least, ["u"], "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = materialise(e.groupBy("u").agg(F.min("v").alias("m")))
    moved = join_measured(e, least, ["u"], "inner", stored=True).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
