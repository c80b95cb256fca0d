"""Connected components of an edge table by alternating large and small stars.

Every round rewires edges to smaller neighbours with one aggregate, one join and one window, so nothing but
whether it was the last one reaches the driver, and a node with very many edges is pre-aggregated.
The rounds end as soon as all edges are stars; none is spent on finding that it changed nothing, as
each costs the driver some ten jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloop.llm.text import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Of distinct edges; a window, as a join would compute ``e`` twice and may go through the driver."""
    least = e.withColumn("m", F.min("b").over(Window.partitionBy("a")))
    return least.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                        F.col("m").alias("b"))


def _are_stars(e: DataFrame) -> bool:
    """Whether each node is the larger end of one edge, or of none and the smaller end of any number:
    then the smaller ends are what their components are named after."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                             F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    counts = e.select(ends.alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("up"), F.max("x.down").alias("down"))
    return counts.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges(a, b)``; label is the smallest node reachable.

    Self-loops, repeated edges and nulls are ignored; no edge gives no row.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = stored(e.distinct(), "edges")
    while not _are_stars(e):
        e = stored(_small_star(_large_star(e).distinct()).distinct(), "edges")
    return e.toDF("node", "label").unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
