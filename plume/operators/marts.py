"""G1-G14 (per-engine summary) and H1-H15 (daily trends).

Both marts are one hash aggregation over the fact table (partial aggregation on
the map side, so a hot engine or a hot day is combined before the shuffle).
Engine ranks are global ranks over range partitions (``plume.operators.keys``); the
daily mart's windows run un-partitioned over one row per day, a small bounded input.

Numbers stay exact: averages of ``decimal`` measures are exact ``decimal``
averages, percentages are exact half-up roundings, and trend tests compare
exact sums (``rate * n * 10 > 12 * sum``) instead of rounded averages.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plume import rules
from plume.functions.columns import (day_of_week_sun0, engine_health, exact_avg, ntz_literal, pct_half_up, ratio_half_up,
                                     to_double, wide_sum)
from plume.operators.keys import global_ranks, written


def _now(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of
    return ntz_literal(as_of)


def engine_name(engine_id: Column) -> Column:
    out = None
    for eid, name in rules.ENGINE_NAMES:
        out = F.when(engine_id == eid, name) if out is None else out.when(engine_id == eid, name)
    return out.otherwise(F.concat(engine_id, F.lit(rules.UNKNOWN_ENGINE_SUFFIX)))


def utilisation(total: Column, n: Column, limit: int) -> Column:
    """ROUND(AVG(x) * 100.0 / limit, 2), exact: sum * 100 / (n * limit), half-up."""
    thousandths = (total * F.lit(1000)).cast("decimal(38,0)")
    return ratio_half_up(thousandths * F.lit(100), n.cast("decimal(30,0)") * F.lit(1000 * limit), 2, 12)


def engine_aggregates(fact: DataFrame) -> DataFrame:
    """One aggregate pass grouped by ``engine_id``."""
    p, f, t = "chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit"
    anomaly = F.col("is_anomaly")
    atype = F.col("anomaly_type")
    agg = fact.groupBy("engine_id").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.avg("fuel_efficiency_ratio").alias("avg_fuel_efficiency_ratio"),
        F.stddev_samp(to_double(p)).alias("stddev_chamber_pressure"),
        F.stddev_samp(to_double(f)).alias("stddev_fuel_flow"),
        F.stddev_samp(to_double(t)).alias("stddev_temperature"),
        F.min(p).alias("min_chamber_pressure_psi"),
        F.max(p).alias("max_chamber_pressure_psi"),
        F.min(f).alias("min_fuel_flow_kg_per_sec"),
        F.max(f).alias("max_fuel_flow_kg_per_sec"),
        F.min(t).alias("min_temperature_fahrenheit"),
        F.max(t).alias("max_temperature_fahrenheit"),
        F.count_if(anomaly).alias("anomaly_count"),
        F.count_if(atype.like("%PRESSURE%")).alias("pressure_anomalies"),
        F.count_if(atype.like("%FUEL%")).alias("fuel_anomalies"),
        F.count_if(atype.like("%TEMPERATURE%")).alias("temperature_anomalies"),
        wide_sum(p).alias("_sum_p"), wide_sum(f).alias("_sum_f"), wide_sum(t).alias("_sum_t"),
        wide_sum("performance_score", 1).alias("_sum_s"),
        F.count(p).alias("_n_p"), F.count(f).alias("_n_f"), F.count(t).alias("_n_t"),
        F.count("performance_score").alias("_n_s"),
        F.min(F.to_date("reading_timestamp")).alias("earliest_reading_date"),
        F.max(F.to_date("reading_timestamp")).alias("latest_reading_date"),
        F.count("airbyte_raw_id").alias("records_with_source_id"),
        F.min("created_at").alias("first_processed_at"),
        F.max("created_at").alias("last_processed_at"),
    )
    return engine_rows(agg)


def engine_rows(agg: DataFrame) -> DataFrame:
    """The engine mart's columns from per-engine sums, counts, extremes and deviations."""
    n = F.col("total_readings")
    score = exact_avg("_sum_s", "_n_s", 5, 9, 1)
    return agg.select(
        "engine_id",
        engine_name(F.col("engine_id")).alias("engine_name"),
        F.lit(rules.ENGINE_TYPE).alias("engine_type"),
        F.lit(rules.MANUFACTURER).alias("manufacturer"),
        F.lit(rules.OPERATIONAL_STATUS).alias("operational_status"),
        F.lit(_dt.date.fromisoformat(rules.INSTALLATION_DATE)).alias("installation_date"),
        n.cast("bigint").alias("total_readings"),
        exact_avg("_sum_p", "_n_p").alias("avg_chamber_pressure_psi"),
        exact_avg("_sum_f", "_n_f").alias("avg_fuel_flow_kg_per_sec"),
        exact_avg("_sum_t", "_n_t").alias("avg_temperature_fahrenheit"),
        "avg_fuel_efficiency_ratio", score.alias("avg_performance_score"),
        "stddev_chamber_pressure", "stddev_fuel_flow", "stddev_temperature",
        "min_chamber_pressure_psi", "max_chamber_pressure_psi",
        "min_fuel_flow_kg_per_sec", "max_fuel_flow_kg_per_sec",
        "min_temperature_fahrenheit", "max_temperature_fahrenheit",
        F.col("anomaly_count").cast("bigint").alias("anomaly_count"),
        pct_half_up("anomaly_count", n).alias("anomaly_rate_percent"),
        F.col("pressure_anomalies").cast("bigint").alias("pressure_anomalies"),
        F.col("fuel_anomalies").cast("bigint").alias("fuel_anomalies"),
        F.col("temperature_anomalies").cast("bigint").alias("temperature_anomalies"),
        utilisation(F.col("_sum_p"), F.col("_n_p"), rules.PRESSURE_LIMIT).alias("pressure_utilization_percent"),
        utilisation(F.col("_sum_f"), F.col("_n_f"), rules.FUEL_LIMIT).alias("fuel_flow_utilization_percent"),
        utilisation(F.col("_sum_t"), F.col("_n_t"), rules.TEMPERATURE_LIMIT).alias("temperature_utilization_percent"),
        "earliest_reading_date", "latest_reading_date",
        n.cast("bigint").alias("burn_phase_readings"),
        score.alias("burn_phase_avg_performance"),
        F.col("records_with_source_id").cast("bigint").alias("records_with_source_id"),
        "first_processed_at", "last_processed_at",
    )


def engine_summary(fact: DataFrame, as_of=None) -> DataFrame:
    """``engine_performance_summary``, ordered by performance rank.

    Unknown engine ids keep their own text, so the number of engines has no bound: the ranks
    (G12) are global ranks over range partitions, no task sees all engines, and the rows are
    written once to the shared folder before they are ranked.
    DESC ranks put NULLs first (the warehouse default); the efficiency average is
    a double, so it is ranked on its value rounded to 6 places.
    """
    return engine_ranks(engine_aggregates(fact), as_of)


def engine_ranks(agg: DataFrame, as_of=None, workdir: str | None = None) -> DataFrame:
    """G12-G14 over the rows of :func:`engine_rows`."""
    ranked = global_ranks(written(agg, "engines", workdir), [
        ("performance_rank", "avg_performance_score", True),
        ("reliability_rank", "anomaly_rate_percent", False),
        ("efficiency_rank", F.round("avg_fuel_efficiency_ratio", 6), True)], workdir=workdir)
    out = ranked.select("*", engine_health(F.col("anomaly_rate_percent")).alias("health_status"),
                        _now(as_of).alias("report_generated_at"))
    return out.orderBy("performance_rank", "engine_id")


def daily_aggregates(fact: DataFrame) -> DataFrame:
    """H1-H7: one aggregate pass grouped by (date, day of week)."""
    hs = F.col("health_status")
    at = F.col("anomaly_type")
    day = F.to_date("reading_timestamp")
    agg = (fact.groupBy(day.alias("date_actual"), day_of_week_sun0("reading_timestamp").alias("day_of_week"))
           .agg(F.count(F.lit(1)).alias("total_readings"),
                F.count_if("is_anomaly").alias("total_anomalies"),
                *[F.count_if(at == a).alias(a.lower() + "_anomalies") for a in rules.ANOMALY_TYPES],
                wide_sum("performance_score", 1).alias("_sum_s"), F.count("performance_score").alias("_n_s"),
                F.min("performance_score").alias("min_daily_performance_score"),
                F.max("performance_score").alias("max_daily_performance_score"),
                F.stddev_samp(to_double("performance_score")).alias("stddev_daily_performance"),
                F.count_distinct("engine_id").alias("active_engines"),
                *[F.count_if(hs == h).alias(h.lower() + "_readings") for h in rules.READING_HEALTH_VALUES],
                F.min("created_at").alias("earliest_processing_time"),
                F.max("created_at").alias("latest_processing_time")))
    n = F.col("total_readings")
    counts = ([a.lower() + "_anomalies" for a in rules.ANOMALY_TYPES]
              + [h.lower() + "_readings" for h in rules.READING_HEALTH_VALUES])
    return agg.select(
        "date_actual", "day_of_week",
        F.col("day_of_week").isin(0, 6).alias("is_weekend"),
        n.cast("bigint").alias("total_readings"),
        F.col("total_anomalies").cast("bigint").alias("total_anomalies"),
        pct_half_up("total_anomalies", n).alias("daily_anomaly_rate_percent"),
        *[F.col(c).cast("bigint").alias(c) for c in counts[:6]],
        exact_avg("_sum_s", "_n_s", 5, 9, 1).alias("avg_daily_performance_score"), "min_daily_performance_score",
        "max_daily_performance_score", "stddev_daily_performance",
        F.col("active_engines").cast("bigint").alias("active_engines"),
        *[F.col(c).cast("bigint").alias(c) for c in counts[6:]],
        "earliest_processing_time", "latest_processing_time",
    )


def daily_trends(fact: DataFrame, as_of=None) -> DataFrame:
    """``daily_anomaly_trends``, newest day first."""
    return daily_trend_windows(daily_aggregates(fact), as_of)


def daily_trend_windows(d: DataFrame, as_of=None) -> DataFrame:
    """H8-H15 over the per-day aggregates (the output shape of ``daily_aggregates``).

    Moving averages and lags are ROW based (a missing day shifts "a week ago"),
    as in the reference. The windows run over one row per day.
    """
    by_day = Window.orderBy("date_actual")
    last7 = by_day.rowsBetween(-(rules.MOVING_WINDOW_ROWS - 1), 0)
    rate, score = F.col("daily_anomaly_rate_percent"), F.col("avg_daily_performance_score")
    t = d.select(
        "*",
        F.avg(rate).over(last7).alias("seven_day_avg_anomaly_rate"),
        F.avg(score).over(last7).alias("seven_day_avg_performance"),
        F.lag(rate, 1).over(by_day).alias("prev_day_anomaly_rate"),
        F.lag(score, 1).over(by_day).alias("prev_day_performance"),
        F.lag(rate, rules.WEEK_LAG_ROWS).over(by_day).alias("week_ago_anomaly_rate"),
        F.lag(score, rules.WEEK_LAG_ROWS).over(by_day).alias("week_ago_performance"),
        F.rank().over(Window.orderBy(rate.desc_nulls_first())).alias("worst_anomaly_day_rank"),
        F.rank().over(Window.orderBy(score.desc_nulls_first())).alias("best_performance_day_rank"),
        # exact window sums for the trend tests
        F.sum(rate).over(last7).alias("_rate_sum7"),
        F.sum(score).over(last7).alias("_score_sum7"),
        F.count(rate).over(last7).alias("_rate_n7"),
        F.count(score).over(last7).alias("_score_n7"),
    )
    dod = F.round(rate - F.col("prev_day_anomaly_rate"), 2)

    def trend(x, total, k, up, down, up_label, down_label):
        # x > up * total / k  <=>  x * k * 10 > up * 10 * total  (exact decimals)
        lhs = x * F.col(k) * 10
        return (F.when(lhs > F.lit(int(float(up) * 10)) * F.col(total), up_label)
                .when(lhs < F.lit(int(float(down) * 10)) * F.col(total), down_label)
                .otherwise("STABLE"))

    out = t.select(
        *[c for c in t.columns if not c.startswith("_")],
        dod.alias("day_over_day_anomaly_change"),
        F.round(score - F.col("prev_day_performance"), 2).alias("day_over_day_performance_change"),
        F.round(rate - F.col("week_ago_anomaly_rate"), 2).alias("week_over_week_anomaly_change"),
        F.round(score - F.col("week_ago_performance"), 2).alias("week_over_week_performance_change"),
        trend(rate, "_rate_sum7", "_rate_n7", rules.ANOMALY_TREND_UP, rules.ANOMALY_TREND_DOWN,
              "DETERIORATING", "IMPROVING").alias("anomaly_trend"),
        trend(score, "_score_sum7", "_score_n7", rules.PERFORMANCE_TREND_UP,
              rules.PERFORMANCE_TREND_DOWN, "IMPROVING", "DETERIORATING").alias("performance_trend"),
        F.when(rate > rules.HIGH_ANOMALY_RATE, rules.ALERTS[0])
        .when(F.col("critical_readings") > 0, rules.ALERTS[1])
        .when(dod > rules.RAPID_CHANGE, rules.ALERTS[2]).alias("alert_flag"),
        _now(as_of).alias("report_generated_at"),
    )
    return out.orderBy(F.col("date_actual").desc())
