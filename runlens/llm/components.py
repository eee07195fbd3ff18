"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.session import stage


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free checksum of edges: equal when a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node of ``links`` (columns u, v).

    Each round hangs every node and its larger neighbours under its smallest neighbour, then does so
    with the smaller neighbours, until no edge changes: a logarithmic number of rounds. A node with many
    neighbours is a minimum, which combines before the shuffle, and a skewed join key, which adaptive
    execution splits. Each round is written to the shared folder. Null ends and loops are ignored.
    """
    edges = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u") != F.col("v")).alias("ok")).where("ok").select("u", "v").distinct())
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    seen = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = stage(small)
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return nodes.join(edges, nodes["node"] == edges["u"], "left").select("node", F.coalesce("v", "node").alias("component"))
