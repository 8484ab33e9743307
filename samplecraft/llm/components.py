"""Connected components of links, by large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import files_for, materialise


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's larger neighbours are linked to the smallest of it and its neighbours. Small star: its
    smaller neighbours and itself are. Only the smallest neighbour is gathered, by a sum combined before the shuffle;
    no node's neighbours are ever brought together."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether no node has two smaller ones, or a smaller and a larger one. One shuffle and one job tell."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.agg(F.max((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))).first()[0] is not True


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, comp`` of all linked nodes: ``comp`` is the smallest node that links reach.

    Steps end when all links are stars, which for n nodes is after about log(n)^2 of them; each is written to the shared
    folder, and only how many links there are and whether one is no star's comes back to the driver. A step
    reads its links several times, so these should have been written before.
    """
    now = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    while not _are_stars(now := materialise(_star(_star(now, True), False), files=files_for(now.count()))):
        pass
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
