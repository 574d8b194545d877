"""Blocks of packed vectors, and pairs of them, for searches of a stated query set against all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paired(queries: DataFrame, candidates: DataFrame, parts: int, deal: str, same: tuple[str, ...] = ()) -> DataFrame:
    """Every query block beside every candidate block that agrees with it in ``same``, one pair a row.

    Candidate blocks are dealt over ``parts`` by their column ``deal`` and each query block is sent
    to all parts, so that no value of ``same``, however common, meets in one task. The columns of
    the query block come out as ``q_<column>``.
    """
    c = candidates.withColumn("part", F.pmod(F.xxhash64(deal), F.lit(parts)).cast("int"))
    q = queries.select(*[F.col(x).alias(f"q_{x}") for x in queries.columns],
                       F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("q_part"))
    on = F.col("part") == F.col("q_part")
    for x in same:
        on &= F.col(x) == F.col(f"q_{x}")
    return (c.repartition(parts, *same, "part")
            .join(q.repartition(parts, *[f"q_{x}" for x in same], "q_part").hint("merge"), on).drop("part", "q_part"))
