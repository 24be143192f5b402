"""Connected components over an edge table, without gathering any group.

Alternating large-star and small-star rounds: every node's neighbours are
re-linked to the smallest node around it until each component is a star.
Each round is a map-side combined minimum and an equi-join per half, written
to the shared folder; hub nodes are ordinary skewed join keys, which adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, label`` for every node of ``edges(u, v)``; the label is its component's smallest node.

    Nulls and self-links are ignored; repeated edges are fine.
    """
    now = scratch.table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct())
    seen = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.table(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = (linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        small = scratch.table(small)
        was, seen = seen, _fingerprint(small)
        scratch.drop(now, large)
        now = small
        if was == seen:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))
