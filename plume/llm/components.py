"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every node of ``edges`` (long columns ``a`` and ``b``) with its smallest member.

    Alternates large-star and small-star steps (each node's larger, then smaller
    neighbours are re-attached to its smallest neighbour) until the edges are stars.
    Every step is an aggregate plus a join and is written to the shared folder; nothing
    but a count and a checksum reaches the driver. Rounds grow with the logarithm of the
    graph's size.

    Returns ``node, root`` for every node that is not its component's smallest. Edges
    with a null end and self-loops say nothing and are skipped; repeated edges count once.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "edges")
    seen = _state(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
        large = stored(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "star")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        e = stored(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
