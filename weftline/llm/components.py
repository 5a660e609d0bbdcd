"""Connected components by alternating large-star and small-star steps, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, merge_join, stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of ``edges`` (``a``, ``b``: long).

    Large-star links each larger neighbour of a node to the node's smallest neighbour, small-star
    the smaller ones; both keep the components and never add edges, and rounds grow with the
    logarithm of the largest component. A step is an aggregation (a minimum, combined before the
    shuffle) and a sort-merge join, so a hub's neighbours never meet in one task as a list, and nothing
    but a count reaches the driver. Each round is written to the checkpoint folder, and the round
    before it is deleted. It ends when every component is a star around its smallest node, which one
    aggregation tells, so no round is run only to see that nothing changes: what the driver keeps of stages and
    tasks grows with the rounds. Self-links and repeated edges are allowed; null ends belong to no edge; no edges give no rows.
    """
    live = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        if stars(live):
            break
        both = live.select("u", "v").unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = merge_join(both.filter("v > u"), least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        joined = merge_join(large, low, F.col("u") == F.col("c"))
        small = joined.select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()
        before, live = live, stored(small)
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    return live.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(live.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def stars(edges: DataFrame) -> bool:
    """Whether each of the distinct ``edges`` (``u`` > ``v``) links a node of no other edge to the centre of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.filter("up > 1 or up > 0 and down > 0").agg(F.count("*").alias("n")).first()["n"] == 0
