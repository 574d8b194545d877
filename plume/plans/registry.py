"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the driver's tables (readings come from ``events``), so its
work grows with them. Outputs are made comparable with the DuckDB oracles:
decimals become doubles, double-valued aggregates are rounded to 4 places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume import rules
from plume.operators import ingest, quality, serving
from plume.operators.history import calibrated, merge_versions, valid_at
from plume.operators.keys import written
from plume.plans.pipeline import AS_OF, Pipeline
from plume.schemas import DIM_ENGINES_SCHEMA
from plume.session import shared_dir
from plume.sources import fixtures
from plume.sources.csv import read_clean_csv, write_clean_csv
from plume.sources.raw import raw_load
from plume.streaming.streams import kpis_from_partials, partials

ROUND4 = {
    "avg_fuel_efficiency_ratio", "stddev_chamber_pressure", "stddev_fuel_flow", "stddev_temperature",
    "stddev_daily_performance", "avg_efficiency",
}


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in ROUND4:
            c = F.round(c.cast("double"), 4)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(spark, sf_dir)


def _lines(spark, sf_dir) -> DataFrame:
    return _p(spark, sf_dir).lines


def _outputs(spark, sf_dir) -> ingest.Outputs:
    return _p(spark, sf_dir).outputs


def _measures_double(df: DataFrame) -> DataFrame:
    for c in rules.MEASURE_FIELDS:
        df = df.withColumn(c, F.trim(c).cast("double"))
    return df


# ------------------------------------------------------------------ ingest

def q_ingest_scan(spark, sf_dir):
    c = ingest.classify_lines(_lines(spark, sf_dir))
    return ingest.emit_rows(c, ~F.col("kind").isin(ingest.BLANK, ingest.COMMENT),
                            F.col("_ord").alias("ord"), "kind")


def q_ingest_parse_errors(spark, sf_dir):
    return _outputs(spark, sf_dir).parse_errors().select(F.col("_ord").alias("ord"), "kind")


def _reasons(spark, sf_dir, cond):
    r = _outputs(spark, sf_dir).drop_reasons()
    return r.where(cond(F.col("reason"))).select(F.col("_ord").alias("ord"), "reason")


def q_ingest_missing_required(spark, sf_dir):
    return _reasons(spark, sf_dir, lambda r: r == ingest.MISSING_REQUIRED)


def q_ingest_bad_timestamp(spark, sf_dir):
    return _reasons(spark, sf_dir, lambda r: r == ingest.BAD_TIMESTAMP)


def q_ingest_bad_numeric(spark, sf_dir):
    return _reasons(spark, sf_dir, lambda r: r.startswith("bad_numeric_"))


def q_clean_readings(spark, sf_dir):
    return _measures_double(_outputs(spark, sf_dir).clean())


def q_clean_csv_roundtrip(spark, sf_dir):
    path = f"{shared_dir(spark)}/plume-clean-csv-{uuid.uuid4().hex}"
    write_clean_csv(_outputs(spark, sf_dir).clean(), path)
    return _measures_double(read_clean_csv(spark, path))


def q_raw_load(spark, sf_dir):
    return _measures_double(raw_load(_outputs(spark, sf_dir).clean(), AS_OF))


def q_dedup_first(spark, sf_dir):
    d = _outputs(spark, sf_dir).deduplicated()
    return d.where(F.col("_copies") > 1).select(
        "timestamp", "engine_id", F.col("_ord").alias("kept_ord"),
        F.col("_copies").cast("bigint").alias("copies"),
        F.trim("chamber_pressure").cast("double").alias("chamber_pressure"))


def q_clean_audit(spark, sf_dir):
    return _outputs(spark, sf_dir).audit().select(
        F.col("_ord").alias("ord"), "step", "rule", "field")


def q_ingest_summary(spark, sf_dir):
    return _outputs(spark, sf_dir).summary()


# ------------------------------------------------------------------ staging

def q_stg_telemetry(spark, sf_dir):
    return _p(spark, sf_dir).staging


def _stg_cols(*cols):
    def q(spark, sf_dir):
        return _p(spark, sf_dir).staging.select("_airbyte_raw_id", *cols)
    return q


# ------------------------------------------------------------------ fact

def _fact_cols(*cols):
    def q(spark, sf_dir):
        return _p(spark, sf_dir).fact_unkeyed.select("airbyte_raw_id", *cols)
    return q


def q_dim_engine_current(spark, sf_dir):
    """every current engine version and how many readings resolve to it (old versions never match)."""
    from plume.operators.dims import current_engines
    p = _p(spark, sf_dir)
    per_key = p.fact_unkeyed.groupBy("engine_key").agg(F.count("airbyte_raw_id").alias("readings"))
    return current_engines(p.engines).join(per_key, "engine_key", "left").select(
        "engine_key", "engine_id", F.coalesce("readings", F.lit(0)).cast("bigint").alias("readings"))


def q_fact_reading_key(spark, sf_dir):
    return _p(spark, sf_dir).fact().select("airbyte_raw_id", "reading_key")


def q_fact_telemetry(spark, sf_dir):
    return _p(spark, sf_dir).fact()


def _engine_history(p):
    history = fixtures.empty_like(p.spark, DIM_ENGINES_SCHEMA)
    stg = written(p.staging, "staged", p.workdir)
    for day in fixtures.DELIVERY_DAYS:
        history = merge_versions(history, fixtures.engine_delivery(stg, day), day, workdir=p.workdir)
    return stg, history


def q_dim_engine_history(spark, sf_dir):
    """A10: the engine dimension after three deliveries, one row per version."""
    _, history = _engine_history(_p(spark, sf_dir))
    return history.select("engine_id", "operational_status", "max_chamber_pressure_psi", "effective_from_date",
                          "effective_to_date", "is_current")


def q_fact_engine_version(spark, sf_dir):
    """F1 over the history: each reading with the engine version that was valid on its date."""
    stg, history = _engine_history(_p(spark, sf_dir))
    return valid_at(stg, history, ("operational_status", "max_chamber_pressure_psi", "effective_from_date")).select(
        "_airbyte_raw_id", "engine_id", "reading_timestamp", "operational_status", "max_chamber_pressure_psi",
        "effective_from_date")


def q_fact_calibrated(spark, sf_dir):
    """A10: every reading's measures, calibrated by the bridge."""
    p = _p(spark, sf_dir)
    fact = p.fact_unkeyed
    bridge = written(fixtures.bridge_from_readings(fact, p.metrics), "bridge", p.workdir)
    return calibrated(fact, bridge, p.metrics).select(
        "airbyte_raw_id", "engine_key", "calibrated_chamber_pressure_psi", "calibrated_fuel_flow_kg_per_sec",
        "calibrated_temperature_fahrenheit")


# ------------------------------------------------------------------ marts (G, H)

def _engine_cols(*cols):
    def q(spark, sf_dir):
        s = _p(spark, sf_dir).engine_summary
        return s.select("engine_id", *cols) if cols else s
    return q


def _daily_cols(*cols):
    def q(spark, sf_dir):
        s = _p(spark, sf_dir).daily_trends
        return s.select("date_actual", *cols) if cols else s
    return q


def q_daily_trends_from_lines(spark, sf_dir):
    """JSON Lines text to the daily mart in one plan: parse, clean, dedup, stage, fact, mart."""
    from plume.operators.fact import fact_unkeyed
    from plume.operators.marts import daily_trends
    from plume.operators.staging import staging
    p = _p(spark, sf_dir)
    raw = raw_load(ingest.clean_lines(p.lines), p.as_of)
    return daily_trends(fact_unkeyed(staging(raw, p.as_of), p.engines, p.metrics), p.as_of)


# ------------------------------------------------------------------ serving (I)

def q_q1(spark, sf_dir):
    p = _p(spark, sf_dir)
    return serving.q1_engine_comparison(p.fact_unkeyed, p.engines)


def q_q2(spark, sf_dir):
    return serving.q2_hourly_anomalies(_p(spark, sf_dir).fact_unkeyed)


def q_q3(spark, sf_dir):
    p = _p(spark, sf_dir)
    return serving.q3_metric_matrix(p.fact_unkeyed, p.engines, p.metrics)


def q_serve_engine_performance(spark, sf_dir):
    return serving.engine_performance(_p(spark, sf_dir).engine_summary)


def q_serve_engine_display(spark, sf_dir):
    """The engine table as displayed (score and rate to one decimal)."""
    return serving.display_rounding(serving.engine_performance(_p(spark, sf_dir).engine_summary))


def q_serve_daily_trends(spark, sf_dir):
    return serving.recent_days(_p(spark, sf_dir).daily_trends)


def q_serve_latest_readings(spark, sf_dir):
    return serving.latest_readings(_p(spark, sf_dir).fact_unkeyed)


def q_serve_recent_anomalies(spark, sf_dir):
    return serving.recent_anomalies(serving.newest(_p(spark, sf_dir).fact_unkeyed))


def q_serve_kpis(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis_from_partials(written(partials(p.fact_unkeyed), "partials", p.workdir))


def q_serve_score_band(spark, sf_dir):
    return serving.engine_score_bands(_p(spark, sf_dir).engine_summary)


def q_serve_series(spark, sf_dir):
    return serving.series(serving.latest_readings(_p(spark, sf_dir).fact_unkeyed))


# ------------------------------------------------------------------ quality (J)

def _models(p: Pipeline, names=None) -> dict:
    """The tested models (all five, or ``names``), as a scheduled test run sees them: built from
    stored tables.

    The raw table is written once to the shared folder; staging and the fact are
    derived from it (the fact through its written, range-sorted key table) and
    the two small marts are stored too, so the 45 tests scan stored data instead
    of re-running the cleaner or the mart aggregations for each test.
    """
    from plume.operators.fact import fact_unkeyed, with_reading_key
    from plume.operators.marts import daily_trends, engine_summary
    from plume.operators.staging import staging
    names = set(names or quality.MODELS)
    path = f"{shared_dir(p.spark)}/plume-raw-{uuid.uuid4().hex}"
    p.raw.write.mode("overwrite").parquet(path)
    raw = p.spark.read.parquet(path)
    stg = staging(raw, p.as_of)
    # the key table is written only where a test reads the key
    fact = fact_unkeyed(stg, p.engines, p.metrics)
    if "fact" in names:
        fact = with_reading_key(fact, workdir=p.workdir)
    stored = {}
    for name, mart in (("engine_summary", engine_summary), ("daily_trends", daily_trends)):
        if name in names:
            mart(fact, p.as_of).write.mode("overwrite").parquet(f"{path}-{name}")     # one row per engine / per day
            stored[name] = p.spark.read.parquet(f"{path}-{name}")
    return {"raw": raw, "staging": stg, "fact": fact, **stored}


def q_dq_report(spark, sf_dir):
    return quality.run_declared_tests(_models(_p(spark, sf_dir)))


def _dq_kind(kind):
    def q(spark, sf_dir):
        tests = [t for t in quality.DECLARED_TESTS if t.kind == kind]
        return quality.run_declared_tests(_models(_p(spark, sf_dir), {t.model for t in tests}), tests)
    return q


def _dirty_models(p: Pipeline) -> dict:
    """What the tests see where nothing was cleaned: every line's record as a raw table, duplicates
    and rejected records included, and the staging of all valid records before deduplication. The
    lines are parsed once, the records staged once, and both written; every test reads them from there."""
    from plume.operators.staging import staging
    records = ingest.with_raw_measures(ingest.records_from_lines(ingest.classify_lines(p.lines)))
    stored = written(ingest.emit_rows(ingest.validate(records), F.col("_kind") == ingest.RECORD, *rules.CSV_COLUMNS,
                                      "_raw_p", "_raw_f", F.col("_status").isNull().alias("_valid")), "records", p.workdir)
    landed = stored.select("timestamp", "engine_id", F.col("_raw_p").alias("chamber_pressure"),
                           F.col("_raw_f").alias("fuel_flow"), "temperature")
    stg = staging(raw_load(stored.where("_valid").select(*rules.CSV_COLUMNS), p.as_of), p.as_of)
    return {"raw": raw_load(landed, p.as_of), "staging": written(stg, "staging", p.workdir)}


def q_dq_dirty(spark, sf_dir):
    """J1-J5 where they fail: raw and staging without dedup, readings graded by a stricter list."""
    return quality.run_declared_tests(_dirty_models(_p(spark, sf_dir)), quality.DIRTY_TESTS)


def q_dq_failing_rows(spark, sf_dir):
    """The stored failing rows of those tests, as one table."""
    spark_dir = f"{shared_dir(spark)}/plume-failures-{uuid.uuid4().hex}"
    paths = quality.store_test_failures(_dirty_models(_p(spark, sf_dir)), spark_dir, quality.DIRTY_TESTS)
    return quality.stored_failures(spark, paths, quality.DIRTY_TESTS)


def q_dq_fact_grain(spark, sf_dir):
    return quality.fact_grain(_p(spark, sf_dir).fact_unkeyed)


_RAW = {
    # A / C: ingest
    "ingest_scan": q_ingest_scan,
    "ingest_parse_errors": q_ingest_parse_errors,
    "ingest_missing_required": q_ingest_missing_required,
    "ingest_bad_timestamp": q_ingest_bad_timestamp,
    "ingest_bad_numeric": q_ingest_bad_numeric,
    "clean_readings": q_clean_readings,
    "clean_csv_roundtrip": q_clean_csv_roundtrip,
    "raw_load": q_raw_load,
    "dedup_first": q_dedup_first,
    "clean_audit": q_clean_audit,
    "ingest_summary": q_ingest_summary,
    # D: staging
    "stg_telemetry": q_stg_telemetry,
    "fuel_efficiency": _stg_cols("fuel_efficiency_ratio"),
    "performance_score": _stg_cols("performance_score"),
    "anomaly_flag": _stg_cols("is_anomaly"),
    "anomaly_type": _stg_cols("anomaly_type"),
    # F: fact
    "dim_engine_current": q_dim_engine_current,
    "fact_engine_lookup": _fact_cols("engine_id", "engine_key"),
    "fact_metric_lookup": _fact_cols("pressure_metric_key", "fuel_flow_metric_key", "temperature_metric_key"),
    "fact_time_key": _fact_cols("time_key"),
    "fact_normal_range": _fact_cols("is_out_of_normal_range"),
    "fact_health_status": _fact_cols("health_status"),
    "fact_reading_key": q_fact_reading_key,
    "fact_telemetry": q_fact_telemetry,
    "dim_engine_history": q_dim_engine_history,
    "fact_engine_version": q_fact_engine_version,
    "fact_calibrated": q_fact_calibrated,
    # G: engine mart
    "engine_summary": _engine_cols(),
    "engine_averages": _engine_cols("total_readings", "avg_chamber_pressure_psi", "avg_fuel_flow_kg_per_sec",
                                    "avg_temperature_fahrenheit", "avg_fuel_efficiency_ratio",
                                    "avg_performance_score"),
    "engine_stddev": _engine_cols("stddev_chamber_pressure", "stddev_fuel_flow", "stddev_temperature"),
    "engine_minmax": _engine_cols("min_chamber_pressure_psi", "max_chamber_pressure_psi",
                                  "min_fuel_flow_kg_per_sec", "max_fuel_flow_kg_per_sec",
                                  "min_temperature_fahrenheit", "max_temperature_fahrenheit"),
    "engine_anomaly_rate": _engine_cols("total_readings", "anomaly_count", "anomaly_rate_percent"),
    "engine_anomaly_families": _engine_cols("pressure_anomalies", "fuel_anomalies", "temperature_anomalies"),
    "engine_utilization": _engine_cols("pressure_utilization_percent", "fuel_flow_utilization_percent",
                                       "temperature_utilization_percent"),
    "engine_lineage": _engine_cols("records_with_source_id", "first_processed_at", "last_processed_at",
                                   "earliest_reading_date", "latest_reading_date"),
    "engine_rankings": _engine_cols("performance_rank", "reliability_rank", "efficiency_rank"),
    "engine_health": _engine_cols("anomaly_rate_percent", "health_status"),
    # H: daily mart
    "daily_trends": _daily_cols(),
    "daily_trends_from_lines": q_daily_trends_from_lines,
    "daily_calendar": _daily_cols("day_of_week", "is_weekend"),
    "daily_anomaly_rate": _daily_cols("total_readings", "total_anomalies", "daily_anomaly_rate_percent"),
    "daily_anomaly_types": _daily_cols(*[a.lower() + "_anomalies" for a in rules.ANOMALY_TYPES]),
    "daily_performance": _daily_cols("avg_daily_performance_score", "min_daily_performance_score",
                                     "max_daily_performance_score", "stddev_daily_performance"),
    "daily_active_engines": _daily_cols("active_engines"),
    "daily_health_mix": _daily_cols(*[h.lower() + "_readings" for h in rules.READING_HEALTH_VALUES]),
    "daily_moving_avg": _daily_cols("seven_day_avg_anomaly_rate", "seven_day_avg_performance"),
    "daily_lags": _daily_cols("prev_day_anomaly_rate", "prev_day_performance", "week_ago_anomaly_rate",
                              "week_ago_performance"),
    "daily_ranks": _daily_cols("worst_anomaly_day_rank", "best_performance_day_rank"),
    "daily_changes": _daily_cols("day_over_day_anomaly_change", "day_over_day_performance_change",
                                 "week_over_week_anomaly_change", "week_over_week_performance_change"),
    "daily_trend_class": _daily_cols("anomaly_trend", "performance_trend"),
    "daily_alerts": _daily_cols("alert_flag"),
    # I: ad-hoc and serving
    "q1_engine_comparison": q_q1,
    "q2_hourly_anomalies": q_q2,
    "q3_metric_matrix": q_q3,
    "serve_engine_performance": q_serve_engine_performance,
    "serve_engine_display": q_serve_engine_display,
    "serve_daily_trends": q_serve_daily_trends,
    "serve_latest_readings": q_serve_latest_readings,
    "serve_kpis": q_serve_kpis,
    "serve_score_band": q_serve_score_band,
    "serve_recent_anomalies": q_serve_recent_anomalies,
    "serve_series": q_serve_series,
    # J: data quality
    "dq_not_null": _dq_kind("not_null"),
    "dq_unique": _dq_kind("unique"),
    "dq_accepted_values": _dq_kind("accepted_values"),
    "dq_unique_combination": _dq_kind("unique_combination"),
    "dq_fact_grain": q_dq_fact_grain,
    "dq_report": q_dq_report,
    "dq_dirty": q_dq_dirty,
    "dq_failing_rows": q_dq_failing_rows,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    out = {k: wrap(v) for k, v in _RAW.items()}
    from plume.plans import extra
    out.update({k: wrap(v) for k, v in extra.queries().items()})
    return out


def oracle_sql() -> dict[str, str]:
    from plume.plans.oracle import oracles
    return oracles()
