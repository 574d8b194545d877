"""a dense global row number without funnelling rows through one task.

``ROW_NUMBER() OVER (ORDER BY k)`` with no PARTITION BY plans an
``Exchange SinglePartition``: every row goes to one task. Instead:

1. range-partition on the (unique) ordering key and sort inside partitions —
   the same balanced shuffle ``orderBy`` does; a hot value of a leading key
   column is split by the trailing unique columns;
2. tag each row with ``monotonically_increasing_id`` (partition index in the
   upper bits, row index inside the partition in the lower 33 bits) and write
   the result once to the shared folder (``spark.checkpoint.dir``), which cuts
   the lineage so a lost executor never forces a re-shuffle;
3. count rows per partition index (one tiny row per partition, reading only the
   tag column), turn the counts into offsets with a running sum, and broadcast
   them — their size is the partition count, a bound we chose;
4. key = offset + index inside the partition + 1.

``global_ranks`` is the same idea for ``RANK() OVER (ORDER BY v)``: values are counted first,
so ties meet in the aggregate, the distinct values are range-partitioned, and each row joins
the rank of its value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plume.session import shared_dir

_LOW_BITS = 33
_LOW_MASK = (1 << _LOW_BITS) - 1


def written(df: DataFrame, tag: str, workdir: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage below what is used more than once."""
    path = f"{workdir or shared_dir(df.sparkSession)}/plume-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_row_number(df: DataFrame, order_cols, name: str = "row_number",
                      num_partitions: int | None = None, workdir: str | None = None) -> DataFrame:
    """Add ``name`` = 1..N following ``order_cols`` (which should form a unique key)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = workdir or shared_dir(spark)
    path = f"{base}/plume-rownum-{uuid.uuid4().hex}"
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = (df.repartitionByRange(n, *cols)
              .sortWithinPartitions(*cols)
              .withColumn("_tag", F.monotonically_increasing_id()))
    ranged.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)

    part = F.shiftright("_tag", _LOW_BITS)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset"))
    keyed = stored.join(F.broadcast(offsets), part == F.col("_part"), "inner")
    return keyed.withColumn(
        name, (F.col("_offset") + F.col("_tag").bitwiseAND(F.lit(_LOW_MASK)) + 1).cast("bigint")
    ).drop("_tag", "_part", "_offset")


def global_ranks(df: DataFrame, ranks, num_partitions: int | None = None, workdir: str | None = None) -> DataFrame:
    """``df`` with one column per ``(name, value, descending)`` of ``ranks``: RANK() over all rows.

    DESC puts NULLs first and ASC puts them last (the warehouse default); equal values share a
    rank. ``value`` is a column or expression of ``df``, which should be cheap to read again (see
    :func:`written`). All ranks share one aggregate over the distinct values and one range
    partitioning; a hot value is one row there, and joins back as an ordinary equi-join.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = [F.col(v) if isinstance(v, str) else v for _, v, _ in ranks]
    types = [df.select(v).schema[0].dataType for v in values]
    one_each = [F.struct(F.lit(i).alias("_which"), *[(v if i == j else F.lit(None)).cast(types[j]).alias(f"_v{j}")
                                                     for j, v in enumerate(values)]) for i in range(len(values))]
    counts = df.select(F.inline(F.array(*one_each))).groupBy("_which", *[f"_v{j}" for j in range(len(values))]).agg(
        F.count(F.lit(1)).alias("_n"))
    order = [F.col("_which"), *[F.col(f"_v{j}").desc_nulls_first() if down else F.col(f"_v{j}").asc_nulls_last()
                                for j, (_, _, down) in enumerate(ranks)]]
    tagged = written(counts.repartitionByRange(n, *order).sortWithinPartitions(*order)
                     .withColumn("_tag", F.monotonically_increasing_id())
                     .withColumn("_part", F.shiftright("_tag", _LOW_BITS)), "ranks", workdir)
    # one row per rank column and partition, a bound we chose
    before = Window.partitionBy("_which").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy("_which", "_part").agg(F.sum("_n").alias("_n")).select(
        "_which", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_which", "_part").orderBy("_tag").rowsBetween(Window.unboundedPreceding, -1)
    ranked = tagged.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        F.broadcast(offsets), ["_which", "_part"])
    ranked = written(ranked.select("_which", *[f"_v{j}" for j in range(len(values))],
                                   (F.col("_offset") + F.col("_inside") + 1).cast("int").alias("_rank")), "ranks", workdir)
    out = df
    for i, (name, _, _) in enumerate(ranks):
        mine = ranked.where(F.col("_which") == i).select(F.col(f"_v{i}").alias("_value"), F.col("_rank").alias(name))
        out = out.join(mine, values[i].eqNullSafe(F.col("_value")), "left").drop("_value")
    return out
