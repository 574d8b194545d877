"""A3: load clean readings into the raw table shape with load metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.functions.columns import ntz_literal

from plume.schemas import RAW_SCHEMA


def raw_id(timestamp: Column, engine_id: Column) -> Column:
    """Reproducible row id: SHA-256 of ``timestamp#engine_id``.

    Unique once records are deduplicated on that pair (a valid timestamp text
    cannot contain ``#``).
    """
    return F.sha2(F.concat_ws("#", timestamp, engine_id), 256)


def raw_load(clean: DataFrame, extracted_at, generation_id: int = 1,
             id_col: str | None = None, passthrough=()) -> DataFrame:
    """Clean CSV-shaped rows -> raw table (``RAW_SCHEMA`` column order).

    ``extracted_at`` is a parameter (a ``datetime`` or a Column) so that loads are
    reproducible; ``id_col`` takes an existing unique id instead of the hash;
    ``passthrough`` columns are carried along after the raw columns.
    """
    ext = extracted_at if isinstance(extracted_at, Column) else ntz_literal(extracted_at)
    rid = F.col(id_col) if id_col else raw_id(F.col("timestamp"), F.col("engine_id"))
    return clean.select(
        rid.cast("string").alias("_airbyte_raw_id"),
        ext.cast("timestamp_ntz").alias("_airbyte_extracted_at"),
        F.lit(generation_id).cast("bigint").alias("_airbyte_generation_id"),
        F.col("engine_id").cast("string"),
        F.col("timestamp").cast("string"),
        F.col("chamber_pressure").cast("string"),
        F.col("fuel_flow").cast("string"),
        F.col("temperature").cast("string"),
        *passthrough,
    ).select(*[f.name for f in RAW_SCHEMA.fields], *passthrough)
