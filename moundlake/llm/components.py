"""Connected components of an undirected graph held as a table of links.

Alternating large-star and small-star steps: every step links the neighbours of a node to the
smallest of them, so the links of a component end in one star around its smallest node. A step is a
minimum per node (combined before the shuffle) and a join with one row per node, whose hot
side the skew-join rule splits; each pair of steps is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moundlake.llm.common import drop_table, put_down


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", most_steps: int = 100) -> DataFrame:
    """Columns node, component (the smallest node reachable) for every node that has a link to another."""
    now = put_down(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    for _ in range(most_steps):
        small = put_down(_small_star(_large_star(now)), "stars")
        same = _fingerprint(small) == _fingerprint(now)
        drop_table(now)
        now = small
        if same:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    raise RuntimeError(f"components did not settle in {most_steps} steps")


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
