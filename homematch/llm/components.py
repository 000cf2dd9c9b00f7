"""Connected components of a graph given by its links.

Links name few nodes again and again, so their files are far smaller than their
rows; joins are merge joins at every size, not broadcasts by the size of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homematch.session import saved


def _are_stars(links: DataFrame) -> bool:
    """Whether every node of links (u, v) is below one other node only or below none, so that each component is one star."""
    nodes = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")), F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))).alias("e")).select("e.*")
    return nodes.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below > 1 OR below = 1 AND above = 1").count() == 0


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its smallest node.

    Large-star and small-star steps by turns until each component is one star
    around its smallest node, which links may be from the start. Each step
    takes smallest neighbours by pre-aggregated minima and joins them back, so
    neither the neighbours of a node nor the links are ever gathered anywhere;
    each result is written to the shared folder, which cuts the lineage.
    """
    held = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    while not _are_stars(held):
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        held = saved(small.select("e.u", "e.v").where("u <> v").distinct(), "small-star")
    roots = held.select(F.col("v").alias("node")).distinct()
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def extended(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts``, the (node, component) of some links, after more links (a, b).

    Only links between different components are looked at, by the names of these,
    so what was found before is not worked out again.
    """
    of_a, of_b = (parts.select(F.col("node").alias(end), F.col("component").alias(f"{end}_part")).hint("merge") for end in "ab")
    named = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b"))
    merged = saved(components(named), "merged")
    moved = parts.join(merged.select(F.col("node").alias("component"), F.col("component").alias("into")).hint("merge"), "component", "left")
    return moved.select("node", F.coalesce("into", "component").alias("component")).unionByName(merged.join(parts.hint("merge"), "node", "left_anti"))
