"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplemart.llm.common import checkpointed


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first())


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """links have a > b. Large: every neighbour above a node is linked to the node's smallest neighbour
    (or the node itself, if that is smaller). Small: so is every neighbour below it, and the node."""
    if large:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    near = sides.join(least, "a")
    near = near.filter("b > a") if large else near.filter("b > least")
    moved = near.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b: long), in any direction, repeats and loops allowed; gives node and root, the
    smallest node it reaches, for every node with a link to another. No link, no row.

    Every round is written to the checkpoint folder. A hub's links meet its root by a join that
    adaptive execution can split; only counts come to the driver."""
    now = checkpointed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    state = _state(now)
    while state[0]:
        now = checkpointed(_stars(_stars(now, large=True), large=False))
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
