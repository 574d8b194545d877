"""Dimension helpers (defaults, current-version filter, metric lookup)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume import rules
from plume.schemas import DIM_ENGINE_DEFAULTS, DIM_ENGINES_SCHEMA


def with_engine_defaults(engines: DataFrame) -> DataFrame:
    """Fill the DDL defaults of ``dim_engines`` for NULL attributes."""
    out = engines
    for name, default in DIM_ENGINE_DEFAULTS.items():
        dtype = DIM_ENGINES_SCHEMA[name].dataType
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default).cast(dtype)))
    out = out.withColumn("manufacturer", F.coalesce("manufacturer", F.lit(rules.MANUFACTURER)))
    out = out.withColumn("effective_from_date", F.coalesce("effective_from_date", F.current_date()))
    return out.select(*[f.name for f in DIM_ENGINES_SCHEMA.fields])


def checked_engines(engines: DataFrame) -> DataFrame:
    """Engines with their defaults (absent columns included), after a check that each key and each
    current engine id occurs once: a second one would multiply readings."""
    for f in DIM_ENGINES_SCHEMA.fields:
        if f.name not in engines.columns:
            engines = engines.withColumn(f.name, F.lit(None).cast(f.dataType))
    engines = with_engine_defaults(engines)
    _once(engines, "engine_key", "engine dimension")
    _once(current_engines(engines), "engine_id", "current engines")
    return engines


def checked_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics, after a check that each key and each name occurs once."""
    _once(metrics, "metric_key", "metric dimension")
    _once(metrics, "metric_name", "metric dimension")
    return metrics


def _once(df: DataFrame, column: str, what: str) -> None:
    again = df.groupBy(column).count().where("count > 1").first()
    if again:
        raise ValueError(f"{what}: {column} {again[0]!r} occurs {again[1]} times")


def current_engines(engines: DataFrame) -> DataFrame:
    """current SCD-2 versions, ``(engine_key, engine_id)``."""
    return engines.where(F.col("is_current") == F.lit(True)).select("engine_key", "engine_id")


def metric_lookup(metrics: DataFrame) -> DataFrame:
    """exactly one row holding, per fixed metric name, its key and normal range.

    The reference attaches each metric with ``LEFT JOIN ... ON name = '<const>'``;
    an aggregate with no grouping always yields one row (NULLs when the metric
    is missing), so a cross join with it keeps every reading and never fans out.
    Decision: when a name occurs twice, the row with the smallest key is used.
    """
    return _metric_lookup_agg(metrics)


def _metric_lookup_agg(metrics: DataFrame) -> DataFrame:
    cols = []
    for prefix, name in (("p", "chamber_pressure"), ("f", "fuel_flow"), ("t", "temperature")):
        cond = F.col("metric_name") == name
        key = F.when(cond, F.col("metric_key"))
        cols.append(F.min(key).alias(f"_{prefix}_key"))
        # the range of the chosen (smallest-key) row of that name
        pick = F.min_by(F.struct("normal_min_value", "normal_max_value"),
                        F.when(cond, F.col("metric_key")))
        cols.append(pick.alias(f"_{prefix}_range"))
    agg = metrics.agg(*cols)
    out = []
    for prefix, label in (("p", "pressure"), ("f", "fuel_flow"), ("t", "temperature")):
        out += [F.col(f"_{prefix}_key").alias(f"{label}_metric_key"),
                F.col(f"_{prefix}_range.normal_min_value").alias(f"{label}_normal_min"),
                F.col(f"_{prefix}_range.normal_max_value").alias(f"{label}_normal_max")]
    return agg.select(*out)
