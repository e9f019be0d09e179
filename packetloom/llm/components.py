"""Connected components of an edge table, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.llm.common import saved


def _star(pairs):
    """(u, v) with both directions, or one -> (u, v, least of u and its neighbours)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    return pairs.join(least, "u")


def components(edges):
    """(u, v) edges -> (node, root): the smallest node of each node's component.

    Every round hangs neighbours under the least node of their star, first the larger
    ones, then the smaller; the table of a round never grows and is written to the shared
    folder. Ends when a round changes nothing, after about log n rounds. Only nodes with
    an edge to another node come back.
    """
    now = saved(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        down = large.filter("u != v").distinct()
        small = _star(down)
        hung = small.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        now = saved(hung.union(small.select("u", F.col("least").alias("v"))).distinct(), "components")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v").distinct()
    )
