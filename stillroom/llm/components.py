"""Connected components of a link table, by alternating large and small stars.

A large star ties every neighbour above a node to the least node of its neighbourhood, a small star does so with the
neighbours below. Repeated in turn they leave one star for each component. Every round is stored in the shared folder,
so that neither the plan nor the work to repeat after a lost executor grows with the rounds; no link reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import stored


def _least(links: DataFrame) -> DataFrame:
    """For each u, the least of u and its neighbours v. Dealt out once more by u, so that both sides of the next join
    come straight from a shuffle and a node with very many neighbours is split there."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least")).repartition("u")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.coalesce(F.sum(F.xxhash64("b", "a") % 1_000_003), F.lit(0))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): root is the least node of its component, itself included.

    Links may repeat, run either way or tie a node to itself; null ends are ignored.
    """
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = stored(ends.filter(F.col("a") != F.col("b")).distinct(), "links")
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = stored(both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("a"), F.col("least").alias("b")).distinct(), "large-star")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = _least(down)
        moved = down.join(least, "u").filter("v <> least").select(F.col("v").alias("a"), F.col("least").alias("b"))
        now = stored(moved.unionByName(least.select(F.col("u").alias("a"), F.col("least").alias("b"))).distinct(), "small-star")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
