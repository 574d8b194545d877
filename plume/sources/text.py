"""A1: JSON Lines scan with an input-order column."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plume.operators.keys import written
from plume.session import shared_dir

LINES_PER_FILE = 100_000


def read_jsonl(spark: SparkSession, paths) -> DataFrame:
    """Read JSON Lines text as ``(value, _ord)``.

    ``_ord`` orders lines as they appear in the input: by file path, then by the
    byte offset of the split, then by position inside the split
    (``monotonically_increasing_id`` grows with the row index inside a task). It
    is a struct so that no offset arithmetic is needed.
    """
    if isinstance(paths, str):
        paths = [paths]
    df = spark.read.text(paths)
    return df.select(
        "value",
        F.struct(F.col("_metadata.file_path").alias("path"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("_ord"),
    )


def numbered_lines(scanned: DataFrame, workdir: str | None = None) -> DataFrame:
    """The lines of ``read_jsonl`` with ``_ord`` as their number, from 1, over all files in input order.

    A split is read by one task from its start to its end, so the place of a line inside it is known
    from the scan, and the lines before a split are a running sum over one small row per split. The
    scanned lines are written once, in files of so many lines that tasks get like shares of them;
    none is sorted or moved.
    """
    split = ["path", "block"]
    path = f"{workdir or shared_dir(scanned.sparkSession)}/plume-numbered-{uuid.uuid4().hex}"
    lines = scanned.select("value", "_ord.*")
    lines.write.option("maxRecordsPerFile", LINES_PER_FILE).parquet(path)
    stored = scanned.sparkSession.read.schema(lines.schema).parquet(path)
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = written(stored.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("row").alias("_first"))
                     .select(*split, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_start")),
                     "splits", workdir)
    return stored.join(F.broadcast(starts), split).select("value", (F.col("_start") + F.col("row")).alias("_ord"))
