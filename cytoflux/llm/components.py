"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoflux.llm.common import Scratch, cut


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either the less end of its edges, or the greater end of one edge alone."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, root (the least node that can be reached) of each node of edges (a, b); equal ends are ignored.

    Every step is a hash aggregation and a join by node, so a hub's neighbours are combined before the shuffle and
    its rows can be split; the number of steps grows as the logarithm of a component's size. Each step's tables are
    dropped when the next one is written; the result belongs to scratch, if given. Repeated edges count once; no edges
    give no rows.
    """
    spark = edges.sparkSession
    held = Scratch(spark)
    now = held.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(now):
        step = Scratch(spark)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        with Scratch(spark) as half:
            large = half.cut(large)
            least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
            small = large.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            now = step.cut(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        held.drop()
        held = step
    with held:
        return (scratch.cut if scratch else cut)(now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
