"""Connected components of a graph given as links, by alternating large and small stars.

Both star steps need each node's smallest neighbour only, so they are an aggregation and a join;
neighbour lists are never gathered.  Nodes with a large share of all links are joined by
broadcast (see ``attach``).  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach, stored

MAX_ROUNDS = 64


def _least(links: DataFrame, total: int) -> DataFrame:
    """``links`` (u, v) with m, the least of u and its neighbours v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("w"))
    met = attach(links, least, ["u"], "w", total, F.col("v"))
    return met.select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``links``: (u, v) longs.  root: the least node."""
    now = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_least(both, 2 * state["n"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        small = _least(large, state["n"])
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(small.select("u", F.col("m").alias("v")))
        now = stored(small.where("u <> v").distinct(), "small-star")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
