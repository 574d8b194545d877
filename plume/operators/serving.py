"""Ad-hoc star-schema queries and dashboard serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume import rules
from plume.functions.columns import exact_avg, score_band, wide_sum


def q1_engine_comparison(fact: DataFrame, engines: DataFrame) -> DataFrame:
    """Q1: per engine id: average pressure, average efficiency, reading count.

    INNER join on ``engine_key`` with *all* versions of the engine dimension, so
    unknown engines (key -1) drop out. The fact is aggregated per ``engine_key``
    before the join (partial aggregation, one row per key), then partial results
    are fanned out through the join exactly as the raw rows would be, and merged
    per ``engine_id``: the join input is tiny whatever the fact size.
    """
    per_key = fact.groupBy("engine_key").agg(
        wide_sum("chamber_pressure_psi").alias("_sp"), F.count("chamber_pressure_psi").alias("_np"),
        F.sum("fuel_efficiency_ratio").alias("_se"), F.count("fuel_efficiency_ratio").alias("_ne"),
        F.count(F.lit(1)).alias("_n"))
    dim = engines.select("engine_key", "engine_id")
    merged = per_key.join(dim, "engine_key", "inner").groupBy("engine_id").agg(
        wide_sum("_sp").alias("_sp"), F.sum("_np").alias("_np"),
        F.sum("_se").alias("_se"), F.sum("_ne").alias("_ne"), F.sum("_n").alias("_n"))
    return merged.select(
        "engine_id",
        F.when(F.col("_np") > 0, exact_avg("_sp", "_np")).alias("avg_pressure"),
        (F.col("_se") / F.col("_ne")).alias("avg_efficiency"),
        F.col("_n").cast("bigint").alias("total_readings"),
    )


def q2_hourly_anomalies(fact: DataFrame) -> DataFrame:
    """Q2: anomalies and readings per (date, hour), most anomalous first."""
    return (fact.groupBy(F.to_date("reading_timestamp").alias("date_actual"),
                         F.hour("reading_timestamp").alias("hour_24"))
            .agg(F.count_if("is_anomaly").cast("bigint").alias("anomaly_count"),
                 F.count(F.lit(1)).cast("bigint").alias("total_readings"))
            .orderBy(F.col("anomaly_count").desc(), "date_actual", "hour_24"))


def q3_metric_matrix(fact: DataFrame, engines: DataFrame, metrics: DataFrame) -> DataFrame:
    """Q3: per (engine id, date, metric category): conditional average pressure / fuel flow.

    Equal to ``fact JOIN engines CROSS JOIN metrics GROUP BY ...`` but computed as
    aggregate-then-join: the fact is reduced to one row per (engine_key, date),
    and the metric dimension to one row per category saying whether the category
    holds the pressure / fuel metric (the averages do not change when a row is
    repeated, only whether a category sees the measure at all).
    """
    day = F.to_date("reading_timestamp").alias("reading_date")
    per_key = fact.groupBy("engine_key", day).agg(
        wide_sum("chamber_pressure_psi").alias("_sp"), F.count("chamber_pressure_psi").alias("_np"),
        wide_sum("fuel_flow_kg_per_sec").alias("_sf"), F.count("fuel_flow_kg_per_sec").alias("_nf"))
    dim = engines.select("engine_key", "engine_id")
    per_engine = per_key.join(dim, "engine_key", "inner").groupBy("engine_id", "reading_date").agg(
        wide_sum("_sp").alias("_sp"), F.sum("_np").alias("_np"),
        wide_sum("_sf").alias("_sf"), F.sum("_nf").alias("_nf"))
    cats = metrics.groupBy("metric_category").agg(
        F.max(F.col("metric_name") == "chamber_pressure").alias("_has_p"),
        F.max(F.col("metric_name") == "fuel_flow").alias("_has_f"))
    grid = per_engine.crossJoin(cats)
    return grid.select(
        "engine_id", "reading_date", "metric_category",
        F.when(F.col("_has_p") & (F.col("_np") > 0), exact_avg("_sp", "_np"))
        .alias("avg_pressure"),
        F.when(F.col("_has_f") & (F.col("_nf") > 0), exact_avg("_sf", "_nf"))
        .alias("avg_fuel_flow"),
    )


# ------------------------------------------------------------------ dashboard reads

def engine_performance(summary: DataFrame) -> DataFrame:
    """I4: the engine table of the dashboard, best score first."""
    return summary.select("engine_id", "engine_name", "avg_performance_score",
                          "anomaly_rate_percent", "health_status", "total_readings",
                          "last_processed_at").orderBy(F.col("avg_performance_score").desc_nulls_last(),
                                                       "engine_id")


def display_rounding(perf: DataFrame) -> DataFrame:
    """Score and rate rounded to one decimal for display."""
    return (perf.withColumn("avg_performance_score", F.round("avg_performance_score", 1))
            .withColumn("anomaly_rate_percent", F.round("anomaly_rate_percent", 1)))


def recent_days(trends: DataFrame, days: int = rules.RECENT_DAYS_LIMIT) -> DataFrame:
    """The latest ``days`` rows of the daily mart (a top-k)."""
    return (trends.select("date_actual", "total_readings", "total_anomalies",
                          "daily_anomaly_rate_percent", "avg_daily_performance_score", "alert_flag")
            .orderBy(F.col("date_actual").desc()).limit(days))


LATEST_COLUMNS = ("reading_timestamp", "engine_id", "chamber_pressure_psi", "fuel_flow_kg_per_sec",
                  "temperature_fahrenheit", "performance_score", "is_anomaly", "anomaly_type",
                  "health_status")


def latest_readings(fact: DataFrame, limit: int = rules.LATEST_READINGS_LIMIT) -> DataFrame:
    """The newest ``limit`` readings (TakeOrderedAndProject: a per-partition top-k)."""
    return newest(fact, limit).select(*LATEST_COLUMNS)


def newest(fact: DataFrame, limit: int = rules.LATEST_READINGS_LIMIT) -> DataFrame:
    """The newest ``limit`` fact rows; equal times go by record id."""
    return fact.orderBy(F.col("reading_timestamp").desc(), F.col("airbyte_raw_id").asc()).limit(limit)


def recent_anomalies(latest: DataFrame, limit: int = rules.RECENT_ANOMALIES_LIMIT) -> DataFrame:
    """Anomalies among the latest readings, first ``limit`` of them.

    The filter runs *after* the latest-N limit, as in the dashboard. ``latest`` comes from
    :func:`newest` and still has the record id, which breaks ties.
    """
    return (latest.where(F.col("is_anomaly"))
            .orderBy(F.col("reading_timestamp").desc(), F.col("airbyte_raw_id").asc()).limit(limit)
            .select("reading_timestamp", "engine_id", "anomaly_type", "chamber_pressure_psi",
                    "fuel_flow_kg_per_sec", "temperature_fahrenheit"))


def kpis(summary: DataFrame, trends: DataFrame, fact: DataFrame) -> DataFrame:
    """One row of dashboard KPIs."""
    eng = summary.agg(F.count(F.lit(1)).cast("bigint").alias("total_engines"),
                      F.count_if(F.col("health_status").isin(*rules.FLIGHT_READY)).cast("bigint")
                      .alias("flight_ready_engines"))
    latest_day = trends.agg(
        F.max_by(F.struct("daily_anomaly_rate_percent", "avg_daily_performance_score", "alert_flag"),
                 "date_actual").alias("d"))
    last_ts = fact.agg(F.max("reading_timestamp").alias("last_reading_timestamp"))
    return eng.crossJoin(latest_day).crossJoin(last_ts).select(
        "total_engines", "flight_ready_engines",
        F.col("d.daily_anomaly_rate_percent").alias("latest_anomaly_rate_percent"),
        F.col("d.avg_daily_performance_score").alias("latest_avg_performance_score"),
        "last_reading_timestamp",
        F.col("d.alert_flag").alias("latest_alert_flag"))


def engine_score_bands(summary: DataFrame) -> DataFrame:
    """I8: gauge colour of each engine's average score."""
    return summary.select("engine_id", "avg_performance_score",
                          score_band(F.col("avg_performance_score")).alias("score_band"))


def series(readings: DataFrame) -> DataFrame:
    """Per-engine time series of the three measures, long format, by time."""
    long = readings.select("engine_id", "reading_timestamp", "chamber_pressure_psi",
                           "fuel_flow_kg_per_sec", "temperature_fahrenheit").unpivot(
        ["engine_id", "reading_timestamp"],
        ["chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit"],
        "metric", "value")
    return long.orderBy("engine_id", "reading_timestamp", "metric")
