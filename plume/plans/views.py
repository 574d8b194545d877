"""A4-A5: expose the models as SQL views so existing SQL runs on Spark unchanged.

``register_models`` creates temporary views named after the models
(``stg_telemetry_readings``, ``fact_telemetry_readings``, ``dim_engines``, ...).
A SQL client that reads these tables can then use ``spark.sql`` instead of a
warehouse connection; Catalyst plans the SQL exactly like the DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MODEL_VIEWS = {
    "raw": "telemetry_data",
    "staging": "stg_telemetry_readings",
    "fact": "fact_telemetry_readings",
    "engine_summary": "engine_performance_summary",
    "daily_trends": "daily_anomaly_trends",
    "engines": "dim_engines",
    "metrics": "dim_telemetry_metrics",
    "bridge": "bridge_engine_metrics",
}


def register_models(spark: SparkSession, models: dict[str, DataFrame], global_views: bool = False) -> dict:
    """Create (or replace) one view per model; returns ``{model: view name}``."""
    names = {}
    for model, df in models.items():
        view = MODEL_VIEWS.get(model, model)
        if global_views:
            df.createOrReplaceGlobalTempView(view)
        else:
            df.createOrReplaceTempView(view)
        names[model] = view
    return names


def register_pipeline(pipeline, keyed: bool = True) -> dict:
    """Views over a ``Pipeline``'s models (the fact with its reading key when ``keyed``)."""
    from plume.sources.fixtures import bridge_engine_metrics

    models = {
        "raw": pipeline.raw,
        "staging": pipeline.staging,
        "fact": pipeline.fact() if keyed else pipeline.fact_unkeyed,
        "engine_summary": pipeline.engine_summary,
        "daily_trends": pipeline.daily_trends,
        "engines": pipeline.engines,
        "metrics": pipeline.metrics,
        "bridge": bridge_engine_metrics(pipeline.engines, pipeline.metrics),
    }
    return register_models(pipeline.spark, models)
