"""Staging model (cast, standardise, score, flag, classify)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume import rules
from plume.functions.columns import (anomaly_type, fuel_efficiency_ratio, is_anomaly,
                                     iso_timestamp_text, ntz_literal, performance_score)
from plume.schemas import STAGING_COLUMNS


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return ntz_literal(as_of)


def _measure(c: str) -> Column:
    """``x::numeric(8,3)``: text is trimmed; values that do not fit become NULL."""
    col = F.col(c)
    return F.btrim(col.cast("string"), F.lit(" \t\n\r\f\u000b")).try_cast("decimal(8,3)")


def _timestamp(c: str, dtype) -> Column:
    if dtype.simpleString() in ("timestamp_ntz", "timestamp"):
        return F.col(c).cast("timestamp_ntz")
    return iso_timestamp_text(F.col(c))


def staging(raw: DataFrame, as_of=None, passthrough=()) -> DataFrame:
    """Raw table -> the 14 staging columns (rows with any NULL business field removed).

    ``as_of`` fills ``processed_at`` (default: the query's current time);
    ``passthrough`` columns (e.g. a stream's watermarked event time) are kept.
    """
    src = raw.select(
        "_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_generation_id",
        F.col("engine_id"),
        _timestamp("timestamp", raw.schema["timestamp"].dataType).alias("reading_timestamp"),
        _measure("chamber_pressure").alias("chamber_pressure_psi"),
        _measure("fuel_flow").alias("fuel_flow_kg_per_sec"),
        _measure("temperature").alias("temperature_fahrenheit"),
        *passthrough,
    )
    src = src.where(
        F.col("engine_id").isNotNull() & F.col("reading_timestamp").isNotNull()
        & F.col("chamber_pressure_psi").isNotNull() & F.col("fuel_flow_kg_per_sec").isNotNull()
        & F.col("temperature_fahrenheit").isNotNull())
    p, f, t = "chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit"
    out = src.select(
        "_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_generation_id",
        F.upper(F.trim("engine_id")).alias("engine_id"),
        "reading_timestamp", p, f, t,
        fuel_efficiency_ratio(f, p).alias("fuel_efficiency_ratio"),
        performance_score(p, f, t).alias("performance_score"),
        is_anomaly(p, f, t).alias("is_anomaly"),
        anomaly_type(p, f, t).alias("anomaly_type"),
        F.lit(rules.SOURCE_SYSTEM).alias("source_system"),
        _as_of(as_of).alias("processed_at"),
        *passthrough,
    )
    return out.select(*STAGING_COLUMNS, *passthrough)
