"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from plume.session import shared_dir

BATCH_BYTES = 2 << 20


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that the cluster shares (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark)}/plume-llm/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage without block-manager copies, so a lost executor costs only its
    running tasks, and leaves a plain scan below the next join, whose exchange AQE can
    then split at a hot key.
    """
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(batch: pa.RecordBatch, column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of about ``limit`` bytes of one text column (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
