"""The star-schema fact table of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume import rules
from plume.functions.columns import reading_health, time_key
from plume.operators.dims import current_engines, metric_lookup
from plume.operators.keys import global_row_number
from plume.schemas import FACT_COLUMNS

# ORDER BY of the surrogate key; the reference orders by (time_key, engine_key)
# only and leaves ties arbitrary — the trailing columns make the order total.
READING_KEY_ORDER = ("time_key", "engine_key", "reading_timestamp", "airbyte_raw_id")


def _out_of_range(value: str, lo: str, hi: str):
    v = F.col(value)
    return (v < F.col(lo)) | (v > F.col(hi))


def fact_unkeyed(stg: DataFrame, engines: DataFrame, metrics: DataFrame) -> DataFrame:
    """Staging -> fact rows without ``reading_key`` (lazy; no materialisation).

    * F2: LEFT join to the current engine versions on ``engine_id``; no match ->
      ``engine_key = -1``. Spark broadcasts the dimension while its size statistics allow it.
    * F3: one cross join with the one-row metric lookup (size 1 by construction).
    * F4-F8: time key, normal-range flag, reading health, renamed columns.
    """
    eng = current_engines(engines)
    lookup = F.broadcast(metric_lookup(metrics))
    joined = stg.join(eng, "engine_id", "left").crossJoin(lookup)
    out_of_range = F.coalesce(
        _out_of_range("chamber_pressure_psi", "pressure_normal_min", "pressure_normal_max")
        | _out_of_range("fuel_flow_kg_per_sec", "fuel_flow_normal_min", "fuel_flow_normal_max")
        | _out_of_range("temperature_fahrenheit", "temperature_normal_min", "temperature_normal_max"),
        F.lit(False))  # a NULL threshold (metric missing) is "not out of range"
    unknown = F.lit(rules.UNKNOWN_KEY)
    return joined.select(
        F.lit(None).cast("bigint").alias("reading_key"),
        F.coalesce(F.col("engine_key"), unknown).cast("int").alias("engine_key"),
        F.coalesce(F.col("pressure_metric_key"), unknown).cast("int").alias("pressure_metric_key"),
        F.coalesce(F.col("fuel_flow_metric_key"), unknown).cast("int").alias("fuel_flow_metric_key"),
        F.coalesce(F.col("temperature_metric_key"), unknown).cast("int").alias("temperature_metric_key"),
        time_key("reading_timestamp").alias("time_key"),
        F.col("_airbyte_raw_id").alias("airbyte_raw_id"),
        "reading_timestamp", "engine_id",
        "chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit",
        "fuel_efficiency_ratio", "performance_score", "is_anomaly",
        out_of_range.alias("is_out_of_normal_range"),
        "anomaly_type",
        reading_health("performance_score").alias("health_status"),
        "source_system",
        F.col("processed_at").alias("created_at"),
        F.col("processed_at").alias("updated_at"),
    )


def with_reading_key(fact: DataFrame, num_partitions: int | None = None,
                     workdir: str | None = None) -> DataFrame:
    """``reading_key`` = global row number in ``READING_KEY_ORDER``.

    Writes the range-sorted rows once under the shared folder (see
    ``plume.operators.keys``); the result is sorted by (time_key, engine_key)
    inside and across partitions, which is also the layout the table is stored in.
    """
    keyed = global_row_number(fact.drop("reading_key"), READING_KEY_ORDER, "reading_key",
                              num_partitions=num_partitions, workdir=workdir)
    return keyed.select(*FACT_COLUMNS)


def fact_telemetry(stg: DataFrame, engines: DataFrame, metrics: DataFrame,
                   num_partitions: int | None = None, workdir: str | None = None) -> DataFrame:
    """The full 21-column fact table."""
    return with_reading_key(fact_unkeyed(stg, engines, metrics), num_partitions, workdir)
