"""Connected components of a link table by alternating large-star and small-star steps.

Each step is one aggregate and one join on the link table; links between two
components shrink to stars, so the rounds grow with the logarithm of the
longest chain.  Links stay in tables; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import discard, land


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links(u, v) of any comparable type -> (node, root), root the least node of the component;
    only nodes with a link to another node appear."""
    links = links.where("u <> v").select("u", "v").distinct()
    seen = None
    before = None
    while True:
        links = land(_small_star(_large_star(links)))
        if before is not None:
            discard(before)
        before = links
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(state)
