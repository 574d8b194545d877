"""Declared schemas and column orders of every table in the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

MEASURE = T.DecimalType(8, 3)

# Clean CSV / cleaner output: all text, missing value -> NULL (empty cell).
CLEAN_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("engine_id", T.StringType()),
    T.StructField("chamber_pressure", T.StringType()),
    T.StructField("fuel_flow", T.StringType()),
    T.StructField("temperature", T.StringType()),
])

def ingest_schema(ord_type: T.DataType) -> T.StructType:
    """What one parse of the lines gives (``operators.ingest.classified_rows``)."""
    text = ("step", "rule", "field", "old_value", "new_value", "record")
    return T.StructType([
        T.StructField("_ord", ord_type), *CLEAN_SCHEMA.fields, T.StructField("corrected", T.BooleanType()),
        *[T.StructField(c, T.IntegerType() if c == "step" else T.StringType()) for c in text],
        T.StructField("output", T.StringType()),
    ])


# Raw warehouse table: the 5 text columns plus load metadata.
RAW_SCHEMA = T.StructType([
    T.StructField("_airbyte_raw_id", T.StringType(), False),
    T.StructField("_airbyte_extracted_at", T.TimestampNTZType(), False),
    T.StructField("_airbyte_generation_id", T.LongType()),
    T.StructField("engine_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("chamber_pressure", T.StringType()),
    T.StructField("fuel_flow", T.StringType()),
    T.StructField("temperature", T.StringType()),
])

STAGING_COLUMNS = (
    "_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_generation_id", "engine_id",
    "reading_timestamp", "chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit",
    "fuel_efficiency_ratio", "performance_score", "is_anomaly", "anomaly_type", "source_system",
    "processed_at",
)

FACT_COLUMNS = (
    "reading_key", "engine_key", "pressure_metric_key", "fuel_flow_metric_key",
    "temperature_metric_key", "time_key", "airbyte_raw_id", "reading_timestamp", "engine_id",
    "chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit",
    "fuel_efficiency_ratio", "performance_score", "is_anomaly", "is_out_of_normal_range",
    "anomaly_type", "health_status", "source_system", "created_at", "updated_at",
)

DIM_ENGINES_SCHEMA = T.StructType([
    T.StructField("engine_key", T.IntegerType(), False),
    T.StructField("engine_id", T.StringType(), False),
    T.StructField("engine_name", T.StringType()),
    T.StructField("engine_type", T.StringType()),
    T.StructField("manufacturer", T.StringType()),
    T.StructField("max_chamber_pressure_psi", T.IntegerType()),
    T.StructField("max_fuel_flow_kg_per_sec", T.IntegerType()),
    T.StructField("max_temperature_fahrenheit", T.IntegerType()),
    T.StructField("installation_date", T.DateType()),
    T.StructField("last_maintenance_date", T.DateType()),
    T.StructField("operational_status", T.StringType()),
    T.StructField("effective_from_date", T.DateType()),
    T.StructField("effective_to_date", T.DateType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

DIM_METRICS_SCHEMA = T.StructType([
    T.StructField("metric_key", T.IntegerType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_category", T.StringType(), False),
    T.StructField("metric_description", T.StringType()),
    T.StructField("unit_of_measure", T.StringType(), False),
    T.StructField("normal_min_value", MEASURE),
    T.StructField("normal_max_value", MEASURE),
    T.StructField("critical_min_value", MEASURE),
    T.StructField("critical_max_value", MEASURE),
    T.StructField("precision_digits", T.IntegerType()),
    T.StructField("data_quality_rules", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

BRIDGE_SCHEMA = T.StructType([
    T.StructField("engine_key", T.IntegerType(), False),
    T.StructField("metric_key", T.IntegerType(), False),
    T.StructField("calibration_factor", T.DecimalType(8, 6)),
    T.StructField("sensor_id", T.StringType()),
])

# Column defaults of dim_engines (applied by ``plume.operators.dims.with_engine_defaults``).
DIM_ENGINE_DEFAULTS = {
    "engine_type": "Rocket Engine",
    "max_chamber_pressure_psi": 350,
    "max_fuel_flow_kg_per_sec": 200,
    "max_temperature_fahrenheit": 4000,
    "operational_status": "ACTIVE",
    "effective_to_date": "2999-12-31",
    "is_current": True,
    "source_system": "MANUAL",
}
