"""Connected components of a table of links by large and small stars, with joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. ``edges`` (a, b), a > b. Large: link larger neighbours to the least one; small: smaller ones."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # Neighbours above the node itself go to the least of node and neighbours.
        up = edges.select(F.col("b").alias("a"), F.col("a").alias("to"))
        out = up.join(least, "a").select(F.col("to").alias("a"), F.least("m", "a").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        near = edges.join(least, "a")
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b long); the component is the least node reachable.

    Null ends and loops are left out. Rounds go on until nothing changes; their number grows with the
    logarithm of the longest path. Every round is written to the shared folder.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a > b").distinct()
    now, seen = written(now, "links"), None
    while True:
        now = written(_star(_star(now, True), False), "links")
        # Stars only are left when every node has one link and no centre has a link upwards.
        mark = tuple(now.agg(F.count("a"), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
