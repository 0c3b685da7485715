"""Connected components over an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.runtime import materialise


def in_blocks(members: DataFrame, by: list[str], member: str, limit: int) -> DataFrame:
    """``members`` with ``block``: groups of over ``limit`` rows are cut into blocks, and each row appears for every pair
    of blocks that its own is in; the others are block 0. Two rows of a group always share a ``block`` number.
    """
    large = members.groupBy(*by).agg(F.count(F.lit(1)).alias("__size")).where(F.col("__size") > limit)
    large = materialise(large, "large")
    if large.isEmpty():
        return members.withColumn("block", F.lit(0).cast("long"))
    k = F.ceil(F.col("__size") / limit)
    mine = F.pmod(F.xxhash64(member), k)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), k - 1), lambda d: F.least(mine, d) * 1_000_000 + F.greatest(mine, d) + 1
    )
    block = F.explode(F.when(F.col("__size").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("block")
    return members.join(large, by, "left").select(*members.columns, block)


def _stamp(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Roots of the nodes in ``edges(u long, v long)``: columns ``node``, ``root`` (smallest node id reachable).

    Each round points every neighbour at the smallest node in reach, first among larger neighbours, then among
    smaller ones. Rounds grow with the logarithm of the longest path. Every step is a partial aggregate and an equi
    join that adaptive execution can split, so a hub of high degree needs no task of its own. Nodes without edges do
    not appear. No edges give an empty result.
    """
    now = materialise(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges"
    )
    seen = _stamp(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = materialise(small, "stars")
        stamp = _stamp(now)
        if stamp == seen:
            break
        seen = stamp
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
