"""Connected components of a graph given as links, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillstream.session import settle


def _large_star(links: DataFrame) -> DataFrame:
    """Ties the larger neighbours of each node to its smallest neighbour or itself."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return row[0], int(row[1])


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node reachable, for each node that has a smaller one; from links(u, v) of two nodes.

    Large and small stars alternate until nothing changes. Every step is a join on a node with the minimum of its
    neighbours, so a hub is a skewed join that Spark splits, and each step is written to the checkpoint folder.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    now = settle(ordered)
    state = _state(now)
    while state[0]:
        now = settle(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
