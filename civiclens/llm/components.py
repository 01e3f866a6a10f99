"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import Scratch

col = F.col


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours on to the smallest node next to it."""
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where(col("v") > col("u")).select(col("v").alias("u"), col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    neighbours = down.join(least, "u").where(col("v") > col("m")).select(col("v").alias("u"), col("m").alias("v"))
    return neighbours.union(least)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node with a link, roots left out.

    ``links`` has the columns u and v, in any direction, with repeats and loops. Both steps work on
    links one by one (a minimum per node and a join), so a node with many links is no single
    group in memory. The steps are repeated until the links stay the same, each written to the
    shared folder.
    """
    current = links.select("u", "v").where("u <> v").distinct()
    state, step = None, 0
    while True:
        # Both steps keep whoever is connected, so a loss of an executor repeats one step at most.
        current = scratch.stage(_large_star(current).distinct(), f"large-{step}")
        current = scratch.stage(_small_star(current).distinct(), f"small-{step}")
        found = current.agg(
            F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("s"), F.sum(F.pmod("v", F.lit(1 << 31))).alias("r")
        ).first()
        if step:
            scratch.drop(f"large-{step - 1}")
            scratch.drop(f"small-{step - 1}")
        if found == state:
            return current.select(col("u").alias("node"), col("v").alias("root"))
        state, step = found, step + 1
