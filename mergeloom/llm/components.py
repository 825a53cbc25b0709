"""Connected components by alternating large-star and small-star contraction.

Every round is two grouped minima and two equi-joins over the edge list; nothing but
an edge count and a checksum reaches the driver, and no node's neighbours are gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(u, v)`` links of longs -> ``(node, root)``: each linked node with its component's smallest node.

    Self-links and nulls are ignored, repeated links count once; nodes without a link to
    another node are absent.  An empty edge table gives an empty result.
    """
    e = cut(edges.where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _signature(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small)
        now = _signature(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40)))).first())
