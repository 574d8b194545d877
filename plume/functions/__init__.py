"""Column-expression helpers: every function returns a ``pyspark.sql.Column``.

All of them compile to built-in Catalyst expressions (no Python UDFs), so they
stay inside whole-stage codegen.
"""

from plume.functions.columns import (  # noqa: F401
    anomaly_type,
    between,
    day_of_week_sun0,
    engine_health,
    fuel_efficiency_ratio,
    is_anomaly,
    iso_timestamp_text,
    measure_text_value,
    ntz_literal,
    numeric_text,
    pct_half_up,
    performance_score,
    reading_health,
    score_band,
    time_key,
    to_double,
)
