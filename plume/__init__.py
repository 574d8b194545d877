"""plume: a Spark-native telemetry analytics pipeline.

Raw JSON Lines readings are parsed, validated, corrected, audited and
deduplicated; staged with scores and anomaly classes; joined to engine and
metric dimensions into a star-schema fact table; summarised into per-engine and
per-day marts; and served to dashboards. Every stage is a lazy
``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"
