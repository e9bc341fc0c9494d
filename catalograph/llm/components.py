"""Connected components of a graph given as links, by alternating star steps over DataFrames.

Every step is a grouped minimum joined back to the links, so no node's neighbours meet in one record, and a
hot node is spread by Spark's skew join. Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.llm.tables import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(20,0)")),
                           F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; the root is the component's least node.

    Links may repeat, point either way or join a node to itself; nulls are ignored. A node that is only
    linked to itself has no row, nor has any node of an empty table.
    """
    links = written(links.select("u", "v").where("u <> v").distinct(), "links")
    before = _digest(links)
    while before[0]:
        links = written(_small_star(_large_star(links)), "stars")
        after = _digest(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
