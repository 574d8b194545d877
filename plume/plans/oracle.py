"""DuckDB SQL oracles for the registered queries.

Each oracle recomputes its query from the raw driver tables with plain SQL —
no code shared with the Spark side. Exact decimal results of the Spark side
(averages of decimals, half-up percentages) are reproduced with integer
arithmetic, ``half_up(num, den, scale)``, so both sides produce the same double.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def half_up(num: str, den: str, scale: int) -> str:
    """num / den rounded half-up (away from zero) at ``scale`` places, as DOUBLE.

    ``num`` and ``den`` are integer-valued SQL expressions, ``den`` > 0.
    """
    m = 2 * 10 ** scale
    return (f"(CAST(CASE WHEN ({num}) >= 0 "
            f"THEN (CAST(({num}) AS HUGEINT) * {m} + ({den})) // (2 * CAST(({den}) AS HUGEINT)) "
            f"ELSE -((CAST(-({num}) AS HUGEINT) * {m} + ({den})) // (2 * CAST(({den}) AS HUGEINT))) END "
            f"AS DOUBLE) / {10 ** scale}.0)")


def half_up_int(num: str, den: str, scale: int) -> str:
    """Like ``half_up`` but returns the integer count of 10^-scale units."""
    m = 2 * 10 ** scale
    return (f"(CASE WHEN ({num}) >= 0 "
            f"THEN (CAST(({num}) AS HUGEINT) * {m} + ({den})) // (2 * CAST(({den}) AS HUGEINT)) "
            f"ELSE -((CAST(-({num}) AS HUGEINT) * {m} + ({den})) // (2 * CAST(({den}) AS HUGEINT))) END)")


def d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


# ---------------------------------------------------------------------------- base CTEs

READINGS = """
b AS (
  SELECT event_id, ts, (event_id*7919)%1000 AS h, event_id%197 AS m, event_id%5 AS e,
         extract(day FROM ts) AS dd,
         (extract(day FROM ts) IN (5,20) AND event_id%50=13) AS burst,
         (extract(day FROM ts) BETWEEN 25 AND 28 AND event_id%2=0) AS sag
  FROM events),
rd AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS raw_id, ts,
   CASE WHEN event_id%11=10 THEN ' tre-099 ' ELSE 'TRE-00' || CAST(e+1 AS VARCHAR) END AS engine_id,
   CAST(CASE WHEN m=23 THEN NULL WHEN m=3 AND e<>2 THEN 30+h*0.04 WHEN m=11 AND e<>2 THEN 410+h*0.1
     WHEN m=17 THEN -(10+h*0.02) WHEN m=59 THEN 0 WHEN burst THEN 410 WHEN dd IN (10,30) AND event_id%3=0 THEN 450
     WHEN dd=15 AND event_id%8=0 THEN 450 WHEN e=1 AND event_id%7 IN (0,1) THEN 420
     WHEN e=3 AND event_id%7=0 THEN 60 WHEN sag THEN 100 ELSE 200+h*0.1 END AS DECIMAL(8,3)) AS p,
   CAST(CASE WHEN m=61 THEN NULL WHEN m=29 OR burst THEN 0 WHEN m=31 AND e<>2 THEN 300+h*0.1
     WHEN m=37 THEN 20 WHEN m=73 THEN 190 ELSE 80+h*0.05 END AS DECIMAL(8,3)) AS f,
   CAST(CASE WHEN m=67 THEN NULL WHEN m=41 AND e<>2 THEN 900+h*0.1 WHEN (m=43 AND e<>2) OR burst THEN 4600+h
     WHEN m=47 THEN -280 WHEN m IN (71,73) OR sag THEN 4300 ELSE 3000+h*1.1 END AS DECIMAL(8,3)) AS t
  FROM b)"""

CLEAN = """
cl AS (
  SELECT raw_id, event_id, ts, engine_id,
    CAST(CASE WHEN p < 0 THEN -p ELSE p END AS DECIMAL(8,3)) AS p,
    CAST(CASE WHEN f = 0 THEN 0.1 ELSE f END AS DECIMAL(8,3)) AS f,
    t
  FROM rd WHERE t IS NULL OR CAST(t AS DOUBLE) >= -273.15)"""

STAGING = f"""
stg AS (
  SELECT raw_id AS _airbyte_raw_id, {AS_OF_SQL} AS _airbyte_extracted_at,
    CAST(1 AS BIGINT) AS _airbyte_generation_id,
    upper(trim(engine_id)) AS engine_id, ts AS reading_timestamp,
    p AS chamber_pressure_psi, f AS fuel_flow_kg_per_sec, t AS temperature_fahrenheit,
    CASE WHEN p > 0 THEN CAST(f AS DOUBLE) / CAST(p AS DOUBLE) END AS fuel_efficiency_ratio,
    CAST((CASE WHEN p BETWEEN 120 AND 350 THEN 0.4 ELSE 0.0 END
        + CASE WHEN f BETWEEN 30 AND 180 THEN 0.3 ELSE 0.0 END
        + CASE WHEN t BETWEEN 1800 AND 4200 THEN 0.3 ELSE 0.0 END) * 100 AS DECIMAL(5,1)) AS performance_score,
    (p < 80 OR p > 400 OR f < 15 OR f > 220 OR t < 1200 OR t > 4500) AS is_anomaly,
    CASE WHEN p < 80 THEN 'LOW_PRESSURE' WHEN p > 400 THEN 'HIGH_PRESSURE'
         WHEN f < 15 THEN 'LOW_FUEL_FLOW' WHEN f > 220 THEN 'HIGH_FUEL_FLOW'
         WHEN t < 1200 THEN 'LOW_TEMPERATURE' WHEN t > 4500 THEN 'HIGH_TEMPERATURE' END AS anomaly_type,
    'AIRBYTE' AS source_system, {AS_OF_SQL} AS processed_at
  FROM cl
  WHERE engine_id IS NOT NULL AND ts IS NOT NULL AND p IS NOT NULL AND f IS NOT NULL AND t IS NOT NULL)"""

ENGINES = """
eng_all AS (SELECT * FROM (VALUES (1,'TRE-001'),(2,'TRE-002'),(3,'TRE-003'),(4,'TRE-004'),(5,'TRE-005'),
                                  (6,'TRE-001')) v(engine_key, engine_id)),
eng AS (SELECT * FROM eng_all WHERE engine_key <= 5)"""

FACT = f"""
fu AS (
  SELECT COALESCE(e.engine_key, -1) AS engine_key, 1 AS pressure_metric_key, 2 AS fuel_flow_metric_key,
    3 AS temperature_metric_key,
    CAST(year(s.reading_timestamp)*1000000 + month(s.reading_timestamp)*10000
         + day(s.reading_timestamp)*100 + hour(s.reading_timestamp) AS BIGINT) AS time_key,
    s._airbyte_raw_id AS airbyte_raw_id, s.reading_timestamp, s.engine_id,
    s.chamber_pressure_psi, s.fuel_flow_kg_per_sec, s.temperature_fahrenheit,
    s.fuel_efficiency_ratio, s.performance_score, s.is_anomaly,
    (s.chamber_pressure_psi < 150 OR s.chamber_pressure_psi > 300 OR s.fuel_flow_kg_per_sec < 50
     OR s.fuel_flow_kg_per_sec > 150 OR s.temperature_fahrenheit < 2000
     OR s.temperature_fahrenheit > 4000) AS is_out_of_normal_range,
    s.anomaly_type,
    CASE WHEN s.performance_score >= 80 THEN 'EXCELLENT' WHEN s.performance_score >= 60 THEN 'GOOD'
         WHEN s.performance_score >= 40 THEN 'FAIR' WHEN s.performance_score >= 20 THEN 'POOR'
         ELSE 'CRITICAL' END AS health_status,
    s.source_system, s.processed_at AS created_at, s.processed_at AS updated_at
  FROM stg s LEFT JOIN eng e ON s.engine_id = e.engine_id),
fact AS (
  SELECT ROW_NUMBER() OVER (ORDER BY time_key, engine_key, reading_timestamp, airbyte_raw_id) AS reading_key, *
  FROM fu)"""


def with_fact(select: str) -> str:
    return "WITH " + ",".join([READINGS, CLEAN, STAGING, ENGINES, FACT]) + "\n" + select


def with_staging(select: str) -> str:
    return "WITH " + ",".join([READINGS, CLEAN, STAGING]) + "\n" + select


# ---------------------------------------------------------------------------- engine mart

ENGINE_MART = f"""
em0 AS (
  SELECT engine_id, count(*) AS n,
    CAST(sum(chamber_pressure_psi) * 1000 AS HUGEINT) AS sp,
    CAST(sum(fuel_flow_kg_per_sec) * 1000 AS HUGEINT) AS sf,
    CAST(sum(temperature_fahrenheit) * 1000 AS HUGEINT) AS st,
    CAST(sum(performance_score) * 10 AS HUGEINT) AS ss,
    avg(fuel_efficiency_ratio) AS avg_eff,
    stddev_samp(CAST(chamber_pressure_psi AS DOUBLE)) AS sd_p,
    stddev_samp(CAST(fuel_flow_kg_per_sec AS DOUBLE)) AS sd_f,
    stddev_samp(CAST(temperature_fahrenheit AS DOUBLE)) AS sd_t,
    min(chamber_pressure_psi) AS min_p, max(chamber_pressure_psi) AS max_p,
    min(fuel_flow_kg_per_sec) AS min_f, max(fuel_flow_kg_per_sec) AS max_f,
    min(temperature_fahrenheit) AS min_t, max(temperature_fahrenheit) AS max_t,
    count(CASE WHEN is_anomaly THEN 1 END) AS a,
    count(CASE WHEN anomaly_type LIKE '%PRESSURE%' THEN 1 END) AS pa,
    count(CASE WHEN anomaly_type LIKE '%FUEL%' THEN 1 END) AS fa,
    count(CASE WHEN anomaly_type LIKE '%TEMPERATURE%' THEN 1 END) AS ta,
    min(CAST(reading_timestamp AS DATE)) AS d0, max(CAST(reading_timestamp AS DATE)) AS d1,
    count(airbyte_raw_id) AS with_id, min(created_at) AS c0, max(created_at) AS c1
  FROM fact GROUP BY engine_id),
em AS (
  SELECT engine_id,
    CASE engine_id WHEN 'TRE-001' THEN 'Terran R Engine Alpha' WHEN 'TRE-002' THEN 'Terran R Engine Beta'
      WHEN 'TRE-003' THEN 'Terran R Engine Gamma' WHEN 'TRE-004' THEN 'Terran R Engine Delta'
      WHEN 'TRE-005' THEN 'Terran R Engine Epsilon' ELSE engine_id || ' (Unknown)' END AS engine_name,
    'Rocket Engine' AS engine_type, 'Relativity Space' AS manufacturer, 'ACTIVE' AS operational_status,
    DATE '2024-01-01' AS installation_date,
    CAST(n AS BIGINT) AS total_readings,
    {half_up('sp', 'n*1000', 7)} AS avg_chamber_pressure_psi,
    {half_up('sf', 'n*1000', 7)} AS avg_fuel_flow_kg_per_sec,
    {half_up('st', 'n*1000', 7)} AS avg_temperature_fahrenheit,
    round(avg_eff, 4) AS avg_fuel_efficiency_ratio,
    {half_up('ss', 'n*10', 5)} AS avg_performance_score,
    {half_up_int('ss', 'n*10', 5)} AS score_k,
    round(sd_p, 4) AS stddev_chamber_pressure, round(sd_f, 4) AS stddev_fuel_flow,
    round(sd_t, 4) AS stddev_temperature,
    {d('min_p')} AS min_chamber_pressure_psi, {d('max_p')} AS max_chamber_pressure_psi,
    {d('min_f')} AS min_fuel_flow_kg_per_sec, {d('max_f')} AS max_fuel_flow_kg_per_sec,
    {d('min_t')} AS min_temperature_fahrenheit, {d('max_t')} AS max_temperature_fahrenheit,
    CAST(a AS BIGINT) AS anomaly_count,
    {half_up('a*100', 'n', 2)} AS anomaly_rate_percent,
    {half_up_int('a*100', 'n', 2)} AS rate_k,
    CAST(pa AS BIGINT) AS pressure_anomalies, CAST(fa AS BIGINT) AS fuel_anomalies,
    CAST(ta AS BIGINT) AS temperature_anomalies,
    {half_up('sp*100', 'n*1000*350', 2)} AS pressure_utilization_percent,
    {half_up('sf*100', 'n*1000*200', 2)} AS fuel_flow_utilization_percent,
    {half_up('st*100', 'n*1000*4000', 2)} AS temperature_utilization_percent,
    d0 AS earliest_reading_date, d1 AS latest_reading_date,
    CAST(n AS BIGINT) AS burn_phase_readings,
    {half_up('ss', 'n*10', 5)} AS burn_phase_avg_performance,
    CAST(with_id AS BIGINT) AS records_with_source_id, c0 AS first_processed_at, c1 AS last_processed_at,
    avg_eff
  FROM em0),
es AS (
  SELECT em.* EXCLUDE (score_k, rate_k, avg_eff),
    CAST(RANK() OVER (ORDER BY score_k DESC NULLS FIRST) AS INTEGER) AS performance_rank,
    CAST(RANK() OVER (ORDER BY rate_k ASC NULLS LAST) AS INTEGER) AS reliability_rank,
    CAST(RANK() OVER (ORDER BY round(avg_eff, 6) DESC NULLS FIRST) AS INTEGER) AS efficiency_rank,
    CASE WHEN rate_k <= 500 THEN 'EXCELLENT' WHEN rate_k <= 1500 THEN 'GOOD'
         WHEN rate_k <= 3000 THEN 'FAIR' ELSE 'NEEDS_ATTENTION' END AS health_status,
    {AS_OF_SQL} AS report_generated_at
  FROM em),
es_k AS (SELECT es.*, em.score_k, em.rate_k FROM es JOIN em USING (engine_id))"""


def engine_mart(select: str) -> str:
    return "WITH " + ",".join([READINGS, CLEAN, STAGING, ENGINES, FACT, ENGINE_MART]) + "\n" + select


# ---------------------------------------------------------------------------- daily mart

DAILY_MART = f"""
dm0 AS (
  SELECT CAST(reading_timestamp AS DATE) AS date_actual, CAST(dayofweek(reading_timestamp) AS INTEGER) AS day_of_week,
    count(*) AS n, count(CASE WHEN is_anomaly THEN 1 END) AS a,
    count(CASE WHEN anomaly_type = 'LOW_PRESSURE' THEN 1 END) AS low_pressure_anomalies,
    count(CASE WHEN anomaly_type = 'HIGH_PRESSURE' THEN 1 END) AS high_pressure_anomalies,
    count(CASE WHEN anomaly_type = 'LOW_FUEL_FLOW' THEN 1 END) AS low_fuel_flow_anomalies,
    count(CASE WHEN anomaly_type = 'HIGH_FUEL_FLOW' THEN 1 END) AS high_fuel_flow_anomalies,
    count(CASE WHEN anomaly_type = 'LOW_TEMPERATURE' THEN 1 END) AS low_temperature_anomalies,
    count(CASE WHEN anomaly_type = 'HIGH_TEMPERATURE' THEN 1 END) AS high_temperature_anomalies,
    CAST(sum(performance_score) * 10 AS HUGEINT) AS ss,
    min(performance_score) AS min_s, max(performance_score) AS max_s,
    stddev_samp(CAST(performance_score AS DOUBLE)) AS sd_s,
    count(DISTINCT engine_id) AS active_engines,
    count(CASE WHEN health_status = 'EXCELLENT' THEN 1 END) AS excellent_readings,
    count(CASE WHEN health_status = 'GOOD' THEN 1 END) AS good_readings,
    count(CASE WHEN health_status = 'FAIR' THEN 1 END) AS fair_readings,
    count(CASE WHEN health_status = 'POOR' THEN 1 END) AS poor_readings,
    count(CASE WHEN health_status = 'CRITICAL' THEN 1 END) AS critical_readings,
    min(created_at) AS earliest_processing_time, max(created_at) AS latest_processing_time
  FROM fact GROUP BY 1, 2),
dm1 AS (
  SELECT *, {half_up_int('a*100', 'n', 2)} AS rk, {half_up_int('ss', 'n*10', 5)} AS sk FROM dm0),
dm2 AS (
  SELECT *,
    sum(rk) OVER w7 AS rsum7, count(rk) OVER w7 AS rn7, sum(sk) OVER w7 AS ssum7, count(sk) OVER w7 AS sn7,
    lag(rk, 1) OVER wd AS prk, lag(sk, 1) OVER wd AS psk, lag(rk, 7) OVER wd AS wrk, lag(sk, 7) OVER wd AS wsk,
    RANK() OVER (ORDER BY rk DESC NULLS FIRST) AS worst_anomaly_day_rank,
    RANK() OVER (ORDER BY sk DESC NULLS FIRST) AS best_performance_day_rank
  FROM dm1
  WINDOW wd AS (ORDER BY date_actual), w7 AS (ORDER BY date_actual ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
dt AS (
  SELECT date_actual, day_of_week, day_of_week IN (0, 6) AS is_weekend,
    CAST(n AS BIGINT) AS total_readings, CAST(a AS BIGINT) AS total_anomalies,
    rk / 100.0 AS daily_anomaly_rate_percent,
    CAST(low_pressure_anomalies AS BIGINT) AS low_pressure_anomalies,
    CAST(high_pressure_anomalies AS BIGINT) AS high_pressure_anomalies,
    CAST(low_fuel_flow_anomalies AS BIGINT) AS low_fuel_flow_anomalies,
    CAST(high_fuel_flow_anomalies AS BIGINT) AS high_fuel_flow_anomalies,
    CAST(low_temperature_anomalies AS BIGINT) AS low_temperature_anomalies,
    CAST(high_temperature_anomalies AS BIGINT) AS high_temperature_anomalies,
    CAST(sk AS DOUBLE) / 100000.0 AS avg_daily_performance_score,
    {d('min_s')} AS min_daily_performance_score, {d('max_s')} AS max_daily_performance_score,
    round(sd_s, 4) AS stddev_daily_performance,
    CAST(active_engines AS BIGINT) AS active_engines,
    CAST(excellent_readings AS BIGINT) AS excellent_readings, CAST(good_readings AS BIGINT) AS good_readings,
    CAST(fair_readings AS BIGINT) AS fair_readings, CAST(poor_readings AS BIGINT) AS poor_readings,
    CAST(critical_readings AS BIGINT) AS critical_readings,
    earliest_processing_time, latest_processing_time,
    {half_up('rsum7', 'rn7*100', 6)} AS seven_day_avg_anomaly_rate,
    {half_up('ssum7', 'sn7*100000', 9)} AS seven_day_avg_performance,
    prk / 100.0 AS prev_day_anomaly_rate, CAST(psk AS DOUBLE) / 100000.0 AS prev_day_performance,
    wrk / 100.0 AS week_ago_anomaly_rate, CAST(wsk AS DOUBLE) / 100000.0 AS week_ago_performance,
    CAST(worst_anomaly_day_rank AS INTEGER) AS worst_anomaly_day_rank,
    CAST(best_performance_day_rank AS INTEGER) AS best_performance_day_rank,
    (rk - prk) / 100.0 AS day_over_day_anomaly_change,
    {half_up('sk - psk', '100000', 2)} AS day_over_day_performance_change,
    (rk - wrk) / 100.0 AS week_over_week_anomaly_change,
    {half_up('sk - wsk', '100000', 2)} AS week_over_week_performance_change,
    CASE WHEN rk * rn7 * 10 > 12 * rsum7 THEN 'DETERIORATING'
         WHEN rk * rn7 * 10 < 8 * rsum7 THEN 'IMPROVING' ELSE 'STABLE' END AS anomaly_trend,
    CASE WHEN sk * sn7 * 10 > 11 * ssum7 THEN 'IMPROVING'
         WHEN sk * sn7 * 10 < 9 * ssum7 THEN 'DETERIORATING' ELSE 'STABLE' END AS performance_trend,
    CASE WHEN rk > 2500 THEN 'HIGH_ANOMALY_ALERT' WHEN critical_readings > 0 THEN 'CRITICAL_HEALTH_ALERT'
         WHEN rk - prk > 1000 THEN 'RAPID_DETERIORATION_ALERT' END AS alert_flag,
    {AS_OF_SQL} AS report_generated_at
  FROM dm2)"""


def daily_mart(select: str) -> str:
    return "WITH " + ",".join([READINGS, CLEAN, STAGING, ENGINES, FACT, DAILY_MART]) + "\n" + select


def marts(select: str) -> str:
    return "WITH " + ",".join([READINGS, CLEAN, STAGING, ENGINES, FACT, ENGINE_MART, DAILY_MART]) + "\n" + select


# ---------------------------------------------------------------------------- dirty JSON Lines

# q = event_id % 89 gives the line kind (see plume.sources.fixtures.jsonl_from_events)
LINES = """
ln0 AS (
  SELECT rd.*, event_id % 89 AS q, (event_id*7919)%1000 AS hh FROM rd),
ln AS (
  SELECT 0 AS part, event_id, q, CASE WHEN q = 25 THEN 'TRE-001' || chr(10) || '"x",\\y' ELSE engine_id END AS engine_id,
    ts, FALSE AS dup,
    CASE WHEN q = 9 THEN '2999-01-01T00:00:00'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || CASE q WHEN 6 THEN 'Z' WHEN 21 THEN '+0000' WHEN 22 THEN '000'
           WHEN 23 THEN '+99:99' ELSE '' END END AS ts_text,
    CASE WHEN q = 19 THEN CAST(-1 AS DECIMAL(9,3)) WHEN q = 7 THEN NULL  -- "chamber_pressure": null
         ELSE CAST(p AS DECIMAL(9,3)) END AS p,
    CASE WHEN q = 19 THEN CAST(0 AS DECIMAL(8,3)) ELSE f END AS f,
    CASE WHEN q = 16 THEN CAST(6000 + hh AS DECIMAL(8,3)) WHEN q = 17 THEN CAST(-273.15 AS DECIMAL(8,3))
         WHEN q = 18 THEN CAST(-273.16 AS DECIMAL(8,3)) ELSE t END AS t
  FROM ln0
  UNION ALL
  SELECT 1, event_id, q, CASE WHEN q = 25 THEN 'TRE-001' || chr(10) || '"x",\\y' ELSE engine_id END, ts, TRUE,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text, CAST(p AS DECIMAL(9,3)) + 1 AS p, f, t
  FROM ln0 WHERE (event_id % 25 = 0 AND q >= 24) OR (q = 4 AND event_id % 2 = 0)
  UNION ALL
  SELECT 2, event_id, 50, 'HOT-1', TIMESTAMP '2024-01-05 00:00:00',
    event_id <> (SELECT min(event_id) FROM rd WHERE event_id % 2 = 0), '2024-01-05T00:00:00.000000', 200, 100, 3000
  FROM rd WHERE event_id % 2 = 0),
lk AS (
  SELECT *,
    CASE WHEN q IN (0, 1) AND NOT dup THEN 'ignored'
         WHEN q IN (2, 10, 11, 15) AND NOT dup THEN 'parse_error' ELSE 'record' END AS kind,
    CASE WHEN dup THEN NULL
         WHEN q IN (0, 1, 2, 10, 11, 15) THEN NULL
         WHEN q IN (3, 12, 13) THEN 'missing_required'
         WHEN q IN (5, 14, 23) THEN 'bad_timestamp'
         WHEN q = 7 THEN 'bad_numeric_chamber_pressure'
         WHEN q = 9 THEN 'bad_numeric_fuel_flow'
         WHEN CAST(t AS DOUBLE) < -273.15 THEN 'below_absolute_zero' END AS status0
  FROM ln),
lv AS (
  SELECT *, row_number() OVER (ORDER BY part, event_id) AS ord,
    CASE WHEN dup AND CAST(t AS DOUBLE) < -273.15 THEN 'below_absolute_zero' ELSE status0 END AS status,
    CASE WHEN q = 4 THEN NULL ELSE engine_id END AS eng_out
  FROM lk)"""


CLEAN_FROM_LINES = """
cl AS (
  SELECT sha256(concat_ws('#', ts_text, eng_out)) AS raw_id, ts, eng_out AS engine_id,
    CAST(abs(p) AS DECIMAL(8,3)) AS p,
    CAST(CASE WHEN f = 0 THEN 0.1 ELSE f END AS DECIMAL(8,3)) AS f,
    CAST(t AS DECIMAL(8,3)) AS t
  FROM lv WHERE kind = 'record' AND status IS NULL AND NOT dup)"""


def lines_daily_mart(select: str) -> str:
    """The daily mart over the cleaned dirty lines (what the streaming marts see)."""
    return "WITH " + ",".join([READINGS, LINES, CLEAN_FROM_LINES, STAGING, ENGINES, FACT, DAILY_MART]) + "\n" + select


def with_lines(select: str) -> str:
    return "WITH " + ",".join([READINGS, LINES]) + "\n" + select


# ---------------------------------------------------------------------------- data quality

RAW_FROM_CLEAN = f"""
rw AS (SELECT raw_id AS _airbyte_raw_id, {AS_OF_SQL} AS _airbyte_extracted_at, engine_id,
              strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM cl)"""

_NN = {
    "raw": ("rw", ["_airbyte_raw_id", "_airbyte_extracted_at", "engine_id", "timestamp"]),
    "staging": ("stg", ["_airbyte_raw_id", "engine_id", "reading_timestamp", "chamber_pressure_psi",
                        "fuel_flow_kg_per_sec", "temperature_fahrenheit", "is_anomaly"]),
    "fact": ("fact", ["reading_key", "engine_key", "pressure_metric_key", "fuel_flow_metric_key",
                      "temperature_metric_key", "time_key", "airbyte_raw_id", "chamber_pressure_psi",
                      "fuel_flow_kg_per_sec", "temperature_fahrenheit", "is_anomaly", "is_out_of_normal_range"]),
    "engine_summary": ("es", ["engine_id", "engine_name", "total_readings", "anomaly_rate_percent",
                              "health_status", "performance_rank"]),
    "daily_trends": ("dt", ["date_actual", "total_readings", "daily_anomaly_rate_percent", "active_engines"]),
}
_UNIQUE = (("raw", "rw", "_airbyte_raw_id"), ("staging", "stg", "_airbyte_raw_id"), ("fact", "fact", "reading_key"),
           ("engine_summary", "es", "engine_id"), ("daily_trends", "dt", "date_actual"))
_ACCEPTED = (("fact", "fact", "is_out_of_normal_range", "(TRUE, FALSE)"),
             ("engine_summary", "es", "health_status", "('EXCELLENT', 'GOOD', 'FAIR', 'NEEDS_ATTENTION')"),
             ("daily_trends", "dt", "anomaly_trend", "('IMPROVING', 'STABLE', 'DETERIORATING')"),
             ("daily_trends", "dt", "performance_trend", "('IMPROVING', 'STABLE', 'DETERIORATING')"))
_COMBO = (("engine_summary", "es", "engine_id"), ("daily_trends", "dt", "date_actual"))


def _row(name: str, model: str, kind: str, col: str, expr: str) -> str:
    return (f"SELECT '{name}' AS test_name, '{model}' AS model, '{kind}' AS test_kind, '{col}' AS column_name, "
            f"CAST(({expr}) AS BIGINT) AS failures")


def _dq_parts(kind: str) -> list[str]:
    parts = []
    if kind == "not_null":
        for model, (cte, cols) in _NN.items():
            for c in cols:
                parts.append(_row(f"not_null:{model}:{c}", model, "not_null", c,
                                  f"SELECT count(*) FROM {cte} WHERE {c} IS NULL"))
    if kind == "unique":
        for model, cte, c in _UNIQUE:
            parts.append(_row(f"unique:{model}:{c}", model, "unique", c,
                              f"SELECT count(*) FROM (SELECT {c} FROM {cte} WHERE {c} IS NOT NULL "
                              f"GROUP BY {c} HAVING count(*) > 1)"))
    if kind == "accepted_values":
        for model, cte, c, vals in _ACCEPTED:
            parts.append(_row(f"accepted_values:{model}:{c}", model, "accepted_values", c,
                              f"SELECT count(*) FROM {cte} WHERE {c} NOT IN {vals}"))
    if kind == "unique_combination":
        for model, cte, c in _COMBO:
            parts.append(_row(f"unique_combination:{model}:{c}", model, "unique_combination", c,
                              f"SELECT count(*) FROM (SELECT {c} FROM {cte} GROUP BY {c} HAVING count(*) > 1)"))
    if kind == "grain":
        parts.append(_row("grain:fact:airbyte_raw_id", "fact", "grain", "airbyte_raw_id",
                          "SELECT count(*) FROM (SELECT airbyte_raw_id FROM fact GROUP BY airbyte_raw_id "
                          "HAVING count(*) > 1)"))
    return parts


def dq_sql(kinds, clean=(CLEAN,), where: str = "TRUE") -> str:
    parts = [p for k in kinds for p in _dq_parts(k)]
    body = " UNION ALL ".join(parts)
    ctes = ",".join([READINGS, *clean, STAGING, ENGINES, FACT, ENGINE_MART, DAILY_MART, RAW_FROM_CLEAN])
    return (f"WITH {ctes}\nSELECT test_name, model, test_kind, column_name, failures, "
            f"CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body}) WHERE {where}")


# records as they arrive: raw of every record line, staging of every valid one, nothing deduplicated
DIRTY = """
rawd AS (
  SELECT CASE WHEN q IN (12, 13) AND NOT dup THEN sha256('')
              ELSE sha256(concat_ws('#', ts_in, eng_in)) END AS _airbyte_raw_id, eng_in AS engine_id, ts_in AS timestamp
  FROM (SELECT *, CASE WHEN NOT dup AND q IN (12, 13) THEN NULL WHEN NOT dup AND q = 14 THEN '5' WHEN NOT dup AND q = 5 THEN 'yesterday' ELSE ts_text END AS ts_in,
               CASE WHEN NOT dup AND q IN (3, 12, 13) THEN NULL ELSE eng_out END AS eng_in FROM lv) WHERE kind = 'record')"""


def _dirty_sql(select: str) -> str:
    stg = """
stgd AS (
  SELECT sha256(concat_ws('#', ts_text, eng_out)) AS _airbyte_raw_id, upper(trim(eng_out)) AS engine_id, ts AS reading_timestamp,
    CASE WHEN p1 < 80 OR p1 > 400 OR f0 < 15 OR f0 > 220 OR t < 1200 OR t > 4500 THEN 'x' END AS anomaly_type
  FROM (SELECT *, abs(p) AS p1, CASE WHEN f = 0 THEN 0.1 ELSE f END AS f0 FROM lv
        WHERE kind = 'record' AND status IS NULL) v
  WHERE eng_out IS NOT NULL AND p1 IS NOT NULL AND f0 IS NOT NULL AND t IS NOT NULL)"""
    return "WITH " + ",".join([READINGS, LINES, DIRTY, stg, _DIRTY_ROWS]) + select


_KNOWN = "('TRE-001', 'TRE-002', 'TRE-003', 'TRE-004', 'TRE-005')"
_DIRTY_ROWS = f"""
fails AS (
  SELECT 'not_null:raw:_airbyte_raw_id' AS test_name, _airbyte_raw_id AS failing, 1 AS n FROM rawd WHERE _airbyte_raw_id IS NULL
  UNION ALL SELECT 'not_null:raw:engine_id', _airbyte_raw_id, 1 FROM rawd WHERE engine_id IS NULL
  UNION ALL SELECT 'not_null:raw:timestamp', _airbyte_raw_id, 1 FROM rawd WHERE timestamp IS NULL
  UNION ALL SELECT 'unique:raw:_airbyte_raw_id', _airbyte_raw_id, count(*) FROM rawd GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'unique:staging:_airbyte_raw_id', _airbyte_raw_id, count(*) FROM stgd GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'unique_combination:staging:engine_id,reading_timestamp',
    engine_id || '|' || rtrim(rtrim(strftime(reading_timestamp, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.'), count(*)
    FROM stgd GROUP BY engine_id, reading_timestamp HAVING count(*) > 1
  UNION ALL SELECT 'accepted_values:staging:engine_id', engine_id, 1 FROM stgd WHERE engine_id NOT IN {_KNOWN}
  UNION ALL SELECT 'not_null:staging:anomaly_type', _airbyte_raw_id, 1 FROM stgd WHERE anomaly_type IS NULL
  UNION ALL SELECT 'grain:staging:_airbyte_raw_id', _airbyte_raw_id, count(*) FROM stgd GROUP BY 2 HAVING count(*) > 1)
"""


# ---------------------------------------------------------------------------- registry

#: Three deliveries of the engine dimension; a version is a run of equal attributes.
_VERSIONS = """,
day AS (SELECT unnest([DATE '2024-01-11', DATE '2024-01-21', DATE '2024-01-31']) AS d),
del AS (
  SELECT d, engine_id, CASE WHEN count(CASE WHEN is_anomaly THEN 1 END) % 2 = 0 THEN 'ACTIVE' ELSE 'MAINTENANCE' END AS st,
    CAST(floor(max(chamber_pressure_psi) / 100) * 100 AS INTEGER) AS mp
  FROM stg JOIN day ON CAST(reading_timestamp AS DATE) < d AND CAST(reading_timestamp AS DATE) >= d - 10
  GROUP BY d, engine_id),
chg AS (SELECT *, lag(st) OVER w AS pst, lag(mp) OVER w AS pmp FROM del WINDOW w AS (PARTITION BY engine_id ORDER BY d)),
ver AS (
  SELECT engine_id, st AS operational_status, mp AS max_chamber_pressure_psi, d AS effective_from_date,
    coalesce(CAST(lead(d) OVER w - 1 AS DATE), DATE '2999-12-31') AS effective_to_date, lead(d) OVER w IS NULL AS is_current
  FROM chg WHERE pst IS DISTINCT FROM st OR pmp IS DISTINCT FROM mp
  WINDOW w AS (PARTITION BY engine_id ORDER BY d))"""


def _times_factor(measure: str, metric: int) -> str:
    """The measure in thousandths times the factor in ten-thousandths, rounded half-up to thousandths (no measure is negative)."""
    factor = f"(CASE WHEN f.engine_key < 0 OR (f.engine_key + {metric}) % 7 = 0 THEN 10000 ELSE 10000 + (c.n * {metric}) % 97 END)"
    thousandths = f"CAST(f.{measure} * 1000 AS BIGINT)"
    return (f"CAST(sign({thousandths}) * ((abs({thousandths}) * {factor} * 2 + 10000) // 20000) AS DOUBLE) / 1000.0 "
            f"AS calibrated_{measure}")


_CALIBRATED = f"""
SELECT f.airbyte_raw_id, CAST(f.engine_key AS INTEGER) AS engine_key, {_times_factor('chamber_pressure_psi', 1)},
  {_times_factor('fuel_flow_kg_per_sec', 2)}, {_times_factor('temperature_fahrenheit', 3)}
FROM fact f LEFT JOIN (SELECT engine_key, count(*) AS n FROM fact GROUP BY engine_key) c ON c.engine_key = f.engine_key"""

STAGING_SELECT_ALL = """SELECT _airbyte_raw_id, _airbyte_extracted_at, _airbyte_generation_id, engine_id,
  reading_timestamp, CAST(chamber_pressure_psi AS DOUBLE) AS chamber_pressure_psi,
  CAST(fuel_flow_kg_per_sec AS DOUBLE) AS fuel_flow_kg_per_sec,
  CAST(temperature_fahrenheit AS DOUBLE) AS temperature_fahrenheit, fuel_efficiency_ratio,
  CAST(performance_score AS DOUBLE) AS performance_score, is_anomaly, anomaly_type, source_system, processed_at
FROM stg"""

FACT_SELECT_ALL = """SELECT reading_key, CAST(engine_key AS INTEGER) AS engine_key,
  CAST(pressure_metric_key AS INTEGER) AS pressure_metric_key,
  CAST(fuel_flow_metric_key AS INTEGER) AS fuel_flow_metric_key,
  CAST(temperature_metric_key AS INTEGER) AS temperature_metric_key, time_key, airbyte_raw_id,
  reading_timestamp, engine_id, CAST(chamber_pressure_psi AS DOUBLE) AS chamber_pressure_psi,
  CAST(fuel_flow_kg_per_sec AS DOUBLE) AS fuel_flow_kg_per_sec,
  CAST(temperature_fahrenheit AS DOUBLE) AS temperature_fahrenheit, fuel_efficiency_ratio,
  CAST(performance_score AS DOUBLE) AS performance_score, is_anomaly, is_out_of_normal_range,
  anomaly_type, health_status, source_system, created_at, updated_at
FROM fact"""

ENGINE_COLS = """engine_id, engine_name, engine_type, manufacturer, operational_status, installation_date,
  total_readings, avg_chamber_pressure_psi, avg_fuel_flow_kg_per_sec, avg_temperature_fahrenheit,
  avg_fuel_efficiency_ratio, avg_performance_score, stddev_chamber_pressure, stddev_fuel_flow,
  stddev_temperature, min_chamber_pressure_psi, max_chamber_pressure_psi, min_fuel_flow_kg_per_sec,
  max_fuel_flow_kg_per_sec, min_temperature_fahrenheit, max_temperature_fahrenheit, anomaly_count,
  anomaly_rate_percent, pressure_anomalies, fuel_anomalies, temperature_anomalies,
  pressure_utilization_percent, fuel_flow_utilization_percent, temperature_utilization_percent,
  earliest_reading_date, latest_reading_date, burn_phase_readings, burn_phase_avg_performance,
  records_with_source_id, first_processed_at, last_processed_at, performance_rank, reliability_rank,
  efficiency_rank, health_status, report_generated_at"""


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    # ---- ingest over dirty JSON Lines
    o["ingest_scan"] = with_lines("SELECT ord, kind FROM lv WHERE kind <> 'ignored'")
    o["ingest_parse_errors"] = with_lines("SELECT ord, kind FROM lv WHERE kind = 'parse_error'")
    o["ingest_missing_required"] = with_lines(
        "SELECT ord, status AS reason FROM lv WHERE status = 'missing_required'")
    o["ingest_bad_timestamp"] = with_lines(
        "SELECT ord, status AS reason FROM lv WHERE status = 'bad_timestamp'")
    o["ingest_bad_numeric"] = with_lines(
        "SELECT ord, status AS reason FROM lv WHERE status LIKE 'bad_numeric_%'")
    clean_sel = """SELECT ts_text AS timestamp, eng_out AS engine_id,
      CAST(abs(p) AS DOUBLE) AS chamber_pressure,
      CASE WHEN f = 0 THEN 0.1 ELSE CAST(f AS DOUBLE) END AS fuel_flow,
      CAST(t AS DOUBLE) AS temperature
    FROM lv WHERE kind = 'record' AND status IS NULL AND NOT dup"""
    o["clean_readings"] = with_lines(clean_sel)
    # streaming K2 keeps the same rows as the batch cleaner (duplicates arrive in a later micro-batch)
    o["stream_dedup"] = with_lines(clean_sel)
    # late: at or before the watermark that the originals leave (whole milliseconds, less 2 hours)
    o["stream_ledger"] = with_lines("""
      , v AS (SELECT * FROM lv WHERE kind = 'record' AND status IS NULL),
      wm AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR AS w FROM v WHERE part = 0),
      a AS (SELECT ts_text, eng_out, ts, part > 0 AND ts <= w AS late, w, ord FROM v, wm),
      n AS (SELECT *, CASE WHEN NOT late THEN row_number() OVER (PARTITION BY ts_text, eng_out, late ORDER BY ord) END AS copy FROM a)
      SELECT ts_text AS timestamp, eng_out AS engine_id,
        CASE WHEN late THEN 'late' WHEN copy = 1 THEN 'on_time' ELSE 'duplicate' END AS outcome,
        CAST(count(*) AS BIGINT) AS readings,
        CAST(max(CASE WHEN late THEN epoch_us(w) - epoch_us(ts) END) AS BIGINT) AS lateness_us
      FROM n GROUP BY 1, 2, 3""")
    o["raw_generations"] = with_lines(f"""SELECT sha256(concat_ws('#', ts_text, eng_out)) AS _airbyte_raw_id,
      {AS_OF_SQL} + CASE WHEN eng_out = 'TRE-002' THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END AS _airbyte_extracted_at,
      CAST(CASE WHEN eng_out = 'TRE-002' THEN 3 ELSE 2 END AS BIGINT) AS _airbyte_generation_id,
      eng_out AS engine_id, ts_text AS timestamp,
      CAST(abs(p) AS DOUBLE) AS chamber_pressure,
      CASE WHEN f = 0 THEN 0.1 ELSE CAST(f AS DOUBLE) END AS fuel_flow,
      CASE WHEN eng_out = 'TRE-002' THEN 3500 ELSE CAST(t AS DOUBLE) END AS temperature
    FROM lv WHERE kind = 'record' AND status IS NULL AND NOT dup AND eng_out IS DISTINCT FROM 'TRE-004'""")
    # streaming K1: every valid record, duplicates included
    o["stream_clean"] = with_lines(clean_sel.replace("AND NOT dup", ""))
    # streaming K4: the daily mart maintained by foreachBatch equals the batch mart of the clean lines
    o["stream_marts"] = lines_daily_mart("SELECT * FROM dt")
    o["stream_dq"] = dq_sql(("not_null", "unique", "accepted_values", "unique_combination", "grain"),
                            (LINES, CLEAN_FROM_LINES), "model IN ('fact', 'engine_summary', 'daily_trends')")
    # the hot key's one reading comes in a later batch than all others
    o["stream_fact"] = lines_daily_mart("""SELECT ROW_NUMBER() OVER (ORDER BY engine_id = 'HOT-1', reading_key) AS reading_key,
      CAST(engine_key AS INTEGER) AS engine_key, time_key,
      airbyte_raw_id, reading_timestamp, engine_id, CAST(chamber_pressure_psi AS DOUBLE) AS chamber_pressure_psi,
      CAST(fuel_flow_kg_per_sec AS DOUBLE) AS fuel_flow_kg_per_sec,
      CAST(temperature_fahrenheit AS DOUBLE) AS temperature_fahrenheit,
      CAST(performance_score AS DOUBLE) AS performance_score, is_anomaly, anomaly_type, health_status FROM fact""")
    o["dim_engine_history"] = with_staging(_VERSIONS + """
SELECT engine_id, operational_status, max_chamber_pressure_psi, effective_from_date, effective_to_date, is_current FROM ver""")
    o["fact_engine_version"] = with_staging(_VERSIONS + """
SELECT s._airbyte_raw_id, s.engine_id, s.reading_timestamp, v.operational_status, v.max_chamber_pressure_psi,
  v.effective_from_date
FROM stg s LEFT JOIN ver v ON v.engine_id = s.engine_id
  AND CAST(s.reading_timestamp AS DATE) BETWEEN v.effective_from_date AND v.effective_to_date""")
    o["fact_calibrated"] = with_fact(_CALIBRATED)
    o["daily_trends_from_lines"] = lines_daily_mart("SELECT * FROM dt")
    o["stream_engine_mart"] = ("WITH " + ",".join([READINGS, LINES, CLEAN_FROM_LINES, STAGING, ENGINES, FACT, ENGINE_MART])
                               + f" SELECT {ENGINE_COLS} FROM es")
    # streaming K3: hourly windows of the clean lines, emitted once the watermark (latest event time
    # of the valid records minus 2 hours) has passed the window end
    o["stream_hourly_anomalies"] = (
        "WITH " + ",".join([READINGS, LINES, CLEAN_FROM_LINES, STAGING]) + """
        , wm AS (SELECT max(ts) - INTERVAL 2 HOUR AS w FROM lv
                 WHERE kind = 'record' AND status IS NULL AND part = 0)
        SELECT date_trunc('hour', reading_timestamp) AS window_start,
               date_trunc('hour', reading_timestamp) + INTERVAL 1 HOUR AS window_end,
               CAST(count(CASE WHEN is_anomaly THEN 1 END) AS BIGINT) AS anomaly_count,
               CAST(count(*) AS BIGINT) AS total_readings
        FROM stg GROUP BY 1, 2
        HAVING date_trunc('hour', reading_timestamp) + INTERVAL 1 HOUR <= (SELECT w FROM wm)""")
    o["materialize"] = with_fact("""
        SELECT 'fact' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM fact
        UNION ALL SELECT 'fact_statistics', CAST(count(*) AS BIGINT) FROM fact
        UNION ALL SELECT 'fact_layout', CAST(count(*) AS BIGINT) FROM fact
        UNION ALL SELECT 'engine_summary', CAST(count(DISTINCT engine_id) AS BIGINT) FROM fact
        UNION ALL SELECT 'daily_trends', CAST(count(DISTINCT CAST(reading_timestamp AS DATE)) AS BIGINT) FROM fact
        UNION ALL SELECT 'engine_summary_from_stored_fact', CAST(count(DISTINCT engine_id) AS BIGINT) FROM fact""")
    o["clean_csv_roundtrip"] = with_lines(clean_sel)
    o["raw_load"] = with_lines(f"""SELECT sha256(concat_ws('#', ts_text, eng_out)) AS _airbyte_raw_id,
      {AS_OF_SQL} AS _airbyte_extracted_at, CAST(1 AS BIGINT) AS _airbyte_generation_id,
      eng_out AS engine_id, ts_text AS timestamp,
      CAST(abs(p) AS DOUBLE) AS chamber_pressure,
      CASE WHEN f = 0 THEN 0.1 ELSE CAST(f AS DOUBLE) END AS fuel_flow,
      CAST(t AS DOUBLE) AS temperature
    FROM lv WHERE kind = 'record' AND status IS NULL AND NOT dup""")
    o["dedup_first"] = with_lines("""
      , v AS (SELECT * FROM lv WHERE kind = 'record' AND status IS NULL),
      k AS (SELECT ts_text, eng_out, count(*) AS copies, min(ord) AS kept_ord FROM v
            GROUP BY ts_text, eng_out HAVING count(*) > 1)
      SELECT k.ts_text AS timestamp, k.eng_out AS engine_id, k.kept_ord, CAST(k.copies AS BIGINT) AS copies,
             CAST(abs(v.p) AS DOUBLE) AS chamber_pressure
      FROM k JOIN v ON v.ord = k.kept_ord""")
    o["clean_audit"] = with_lines("""
      SELECT ord, 0 AS step, 'parse_error' AS rule, CAST(NULL AS VARCHAR) AS field FROM lv WHERE kind = 'parse_error'
      UNION ALL SELECT ord, 1, 'missing_required', NULL FROM lv WHERE status = 'missing_required'
      UNION ALL SELECT ord, 2, 'bad_timestamp', 'timestamp' FROM lv WHERE status = 'bad_timestamp'
      UNION ALL SELECT ord, 3, 'bad_numeric', 'chamber_pressure' FROM lv
        WHERE status = 'bad_numeric_chamber_pressure'
      UNION ALL SELECT ord, 4, 'negative_pressure_corrected', 'chamber_pressure' FROM lv
        WHERE kind = 'record' AND (status IS NULL OR status NOT IN ('missing_required', 'bad_timestamp'))
          AND p < 0
      UNION ALL SELECT ord, 5, 'bad_numeric', 'fuel_flow' FROM lv WHERE status = 'bad_numeric_fuel_flow'
      UNION ALL SELECT ord, 6, 'zero_fuel_corrected', 'fuel_flow' FROM lv
        WHERE kind = 'record' AND (status IS NULL OR status NOT IN ('missing_required', 'bad_timestamp',
          'bad_numeric_chamber_pressure', 'bad_numeric_fuel_flow')) AND f = 0
      UNION ALL SELECT ord, 8, 'below_absolute_zero', 'temperature' FROM lv WHERE status = 'below_absolute_zero'
      UNION ALL SELECT ord, 9, 'high_temperature_warning', 'temperature' FROM lv
        WHERE kind = 'record' AND (status IS NULL OR status NOT IN ('missing_required', 'bad_timestamp',
          'bad_numeric_chamber_pressure', 'bad_numeric_fuel_flow')) AND t > 6000
      UNION ALL SELECT ord, 10, 'duplicate_removed', NULL FROM lv WHERE dup AND status IS NULL""")
    o["ingest_summary"] = with_lines(f"""
      , s AS (SELECT count(*) FILTER (WHERE kind = 'record') AS total,
          count(*) FILTER (WHERE kind = 'parse_error') AS perr,
          count(*) FILTER (WHERE kind = 'record' AND status IS NULL) AS valid,
          count(*) FILTER (WHERE kind = 'record' AND status IS NULL AND (p < 0 OR f = 0)) AS corr,
          count(*) FILTER (WHERE dup AND status IS NULL) AS dups FROM lv)
      SELECT CAST(total AS BIGINT) AS total_records, CAST(valid AS BIGINT) AS valid_records,
        CAST(total - valid AS BIGINT) AS dropped_records, CAST(corr AS BIGINT) AS corrected_records,
        CAST(dups AS BIGINT) AS duplicate_records, CAST(perr AS BIGINT) AS parsing_errors,
        {half_up('valid*100', 'total', 1)} AS success_rate_percent,
        {half_up('(valid - dups)*100', 'total', 1)} AS output_rate_percent,
        CAST(valid - dups AS BIGINT) AS unique_records
      FROM s""")
    # ---- staging
    o["stg_telemetry"] = with_staging(STAGING_SELECT_ALL)
    o["fuel_efficiency"] = with_staging("SELECT _airbyte_raw_id, fuel_efficiency_ratio FROM stg")
    o["performance_score"] = with_staging(
        "SELECT _airbyte_raw_id, CAST(performance_score AS DOUBLE) AS performance_score FROM stg")
    o["anomaly_flag"] = with_staging("SELECT _airbyte_raw_id, is_anomaly FROM stg")
    o["anomaly_type"] = with_staging("SELECT _airbyte_raw_id, anomaly_type FROM stg")
    # ---- fact
    o["dim_engine_current"] = with_fact(
        "SELECT CAST(e.engine_key AS INTEGER) AS engine_key, e.engine_id, CAST(count(f.airbyte_raw_id) AS BIGINT) AS readings "
        "FROM eng e LEFT JOIN fact f ON e.engine_key = f.engine_key GROUP BY ALL")
    o["fact_engine_lookup"] = with_fact(
        "SELECT airbyte_raw_id, engine_id, CAST(engine_key AS INTEGER) AS engine_key FROM fact")
    o["fact_metric_lookup"] = with_fact("""SELECT airbyte_raw_id,
      CAST(pressure_metric_key AS INTEGER) AS pressure_metric_key,
      CAST(fuel_flow_metric_key AS INTEGER) AS fuel_flow_metric_key,
      CAST(temperature_metric_key AS INTEGER) AS temperature_metric_key FROM fact""")
    o["fact_time_key"] = with_fact("SELECT airbyte_raw_id, time_key FROM fact")
    o["fact_normal_range"] = with_fact("SELECT airbyte_raw_id, is_out_of_normal_range FROM fact")
    o["fact_health_status"] = with_fact("SELECT airbyte_raw_id, health_status FROM fact")
    o["fact_reading_key"] = with_fact("SELECT airbyte_raw_id, reading_key FROM fact")
    o["fact_telemetry"] = with_fact(FACT_SELECT_ALL)
    # ---- engine mart
    o["engine_summary"] = engine_mart(f"SELECT {ENGINE_COLS} FROM es")
    o["engine_averages"] = engine_mart("""SELECT engine_id, total_readings, avg_chamber_pressure_psi,
      avg_fuel_flow_kg_per_sec, avg_temperature_fahrenheit, avg_fuel_efficiency_ratio, avg_performance_score
      FROM es""")
    o["engine_stddev"] = engine_mart(
        "SELECT engine_id, stddev_chamber_pressure, stddev_fuel_flow, stddev_temperature FROM es")
    o["engine_minmax"] = engine_mart("""SELECT engine_id, min_chamber_pressure_psi, max_chamber_pressure_psi,
      min_fuel_flow_kg_per_sec, max_fuel_flow_kg_per_sec, min_temperature_fahrenheit,
      max_temperature_fahrenheit FROM es""")
    o["engine_anomaly_rate"] = engine_mart(
        "SELECT engine_id, total_readings, anomaly_count, anomaly_rate_percent FROM es")
    o["engine_anomaly_families"] = engine_mart(
        "SELECT engine_id, pressure_anomalies, fuel_anomalies, temperature_anomalies FROM es")
    o["engine_utilization"] = engine_mart("""SELECT engine_id, pressure_utilization_percent,
      fuel_flow_utilization_percent, temperature_utilization_percent FROM es""")
    o["engine_lineage"] = engine_mart("""SELECT engine_id, records_with_source_id, first_processed_at,
      last_processed_at, earliest_reading_date, latest_reading_date FROM es""")
    o["engine_rankings"] = engine_mart(
        "SELECT engine_id, performance_rank, reliability_rank, efficiency_rank FROM es")
    o["engine_health"] = engine_mart("SELECT engine_id, anomaly_rate_percent, health_status FROM es")
    # ---- daily mart
    o["daily_trends"] = daily_mart("SELECT * FROM dt")
    o["daily_calendar"] = daily_mart("SELECT date_actual, day_of_week, is_weekend FROM dt")
    o["daily_anomaly_rate"] = daily_mart(
        "SELECT date_actual, total_readings, total_anomalies, daily_anomaly_rate_percent FROM dt")
    o["daily_anomaly_types"] = daily_mart("""SELECT date_actual, low_pressure_anomalies,
      high_pressure_anomalies, low_fuel_flow_anomalies, high_fuel_flow_anomalies,
      low_temperature_anomalies, high_temperature_anomalies FROM dt""")
    o["daily_performance"] = daily_mart("""SELECT date_actual, avg_daily_performance_score,
      min_daily_performance_score, max_daily_performance_score, stddev_daily_performance FROM dt""")
    o["daily_active_engines"] = daily_mart("SELECT date_actual, active_engines FROM dt")
    o["daily_health_mix"] = daily_mart("""SELECT date_actual, excellent_readings, good_readings,
      fair_readings, poor_readings, critical_readings FROM dt""")
    o["daily_moving_avg"] = daily_mart(
        "SELECT date_actual, seven_day_avg_anomaly_rate, seven_day_avg_performance FROM dt")
    o["daily_lags"] = daily_mart("""SELECT date_actual, prev_day_anomaly_rate, prev_day_performance,
      week_ago_anomaly_rate, week_ago_performance FROM dt""")
    o["daily_ranks"] = daily_mart(
        "SELECT date_actual, worst_anomaly_day_rank, best_performance_day_rank FROM dt")
    o["daily_changes"] = daily_mart("""SELECT date_actual, day_over_day_anomaly_change,
      day_over_day_performance_change, week_over_week_anomaly_change, week_over_week_performance_change
      FROM dt""")
    o["daily_trend_class"] = daily_mart("SELECT date_actual, anomaly_trend, performance_trend FROM dt")
    o["daily_alerts"] = daily_mart("SELECT date_actual, alert_flag FROM dt")
    # ---- ad-hoc and serving
    o["q1_engine_comparison"] = with_fact(f""", q1 AS (
        SELECT e.engine_id, count(f.chamber_pressure_psi) AS np,
          CAST(sum(f.chamber_pressure_psi) * 1000 AS HUGEINT) AS sp,
          sum(f.fuel_efficiency_ratio) AS se, count(f.fuel_efficiency_ratio) AS ne, count(*) AS n
        FROM fact f JOIN eng_all e ON f.engine_key = e.engine_key GROUP BY e.engine_id)
      SELECT engine_id, CASE WHEN np > 0 THEN {half_up('sp', 'np*1000', 7)} END AS avg_pressure,
        round(se / ne, 4) AS avg_efficiency, CAST(n AS BIGINT) AS total_readings FROM q1""")
    o["q2_hourly_anomalies"] = with_fact("""SELECT CAST(reading_timestamp AS DATE) AS date_actual,
      CAST(hour(reading_timestamp) AS INTEGER) AS hour_24,
      CAST(count(CASE WHEN is_anomaly THEN 1 END) AS BIGINT) AS anomaly_count,
      CAST(count(*) AS BIGINT) AS total_readings
      FROM fact GROUP BY 1, 2 ORDER BY anomaly_count DESC""")
    o["q3_metric_matrix"] = with_fact(f""", mets AS (SELECT * FROM (VALUES (1, 'chamber_pressure', 'PRESSURE'),
          (2, 'fuel_flow', 'FLOW'), (3, 'temperature', 'TEMPERATURE')) v(metric_key, metric_name, metric_category)),
      q3 AS (SELECT e.engine_id, CAST(f.reading_timestamp AS DATE) AS reading_date, m.metric_category,
          count(CASE WHEN m.metric_name = 'chamber_pressure' THEN f.chamber_pressure_psi END) AS np,
          CAST(sum(CASE WHEN m.metric_name = 'chamber_pressure' THEN f.chamber_pressure_psi END) * 1000 AS HUGEINT) AS sp,
          count(CASE WHEN m.metric_name = 'fuel_flow' THEN f.fuel_flow_kg_per_sec END) AS nf,
          CAST(sum(CASE WHEN m.metric_name = 'fuel_flow' THEN f.fuel_flow_kg_per_sec END) * 1000 AS HUGEINT) AS sf
        FROM fact f JOIN eng_all e ON f.engine_key = e.engine_key CROSS JOIN mets m
        GROUP BY e.engine_id, CAST(f.reading_timestamp AS DATE), m.metric_category)
      SELECT engine_id, reading_date, metric_category,
        CASE WHEN np > 0 THEN {half_up('sp', 'np*1000', 7)} END AS avg_pressure,
        CASE WHEN nf > 0 THEN {half_up('sf', 'nf*1000', 7)} END AS avg_fuel_flow FROM q3""")
    o["serve_engine_performance"] = engine_mart("""SELECT engine_id, engine_name, avg_performance_score,
      anomaly_rate_percent, health_status, total_readings, last_processed_at FROM es
      ORDER BY avg_performance_score DESC""")
    o["serve_engine_display"] = engine_mart(f"""SELECT engine_id, engine_name,
      {half_up('score_k', '100000', 1)} AS avg_performance_score,
      {half_up('rate_k', '100', 1)} AS anomaly_rate_percent, health_status, total_readings, last_processed_at
      FROM es_k""")
    o["serve_daily_trends"] = daily_mart("""SELECT date_actual, total_readings, total_anomalies,
      daily_anomaly_rate_percent, avg_daily_performance_score, alert_flag FROM dt
      ORDER BY date_actual DESC LIMIT 7""")
    latest = """SELECT reading_timestamp, engine_id, CAST(chamber_pressure_psi AS DOUBLE) AS chamber_pressure_psi,
      CAST(fuel_flow_kg_per_sec AS DOUBLE) AS fuel_flow_kg_per_sec,
      CAST(temperature_fahrenheit AS DOUBLE) AS temperature_fahrenheit,
      CAST(performance_score AS DOUBLE) AS performance_score, is_anomaly, anomaly_type, health_status
      FROM fact ORDER BY reading_timestamp DESC, airbyte_raw_id ASC LIMIT 50"""
    o["serve_latest_readings"] = with_fact(latest)
    o["serve_recent_anomalies"] = with_fact(f""", lt AS ({latest.replace("health_status", "health_status, airbyte_raw_id", 1)})
      SELECT reading_timestamp, engine_id, anomaly_type, chamber_pressure_psi, fuel_flow_kg_per_sec,
        temperature_fahrenheit FROM lt WHERE is_anomaly ORDER BY reading_timestamp DESC, airbyte_raw_id ASC LIMIT 10""")
    o["serve_kpis"] = marts("""SELECT
        (SELECT CAST(count(*) AS BIGINT) FROM es) AS total_engines,
        (SELECT CAST(count(*) AS BIGINT) FROM es WHERE health_status IN ('EXCELLENT', 'GOOD')) AS flight_ready_engines,
        (SELECT daily_anomaly_rate_percent FROM dt ORDER BY date_actual DESC LIMIT 1) AS latest_anomaly_rate_percent,
        (SELECT avg_daily_performance_score FROM dt ORDER BY date_actual DESC LIMIT 1) AS latest_avg_performance_score,
        (SELECT max(reading_timestamp) FROM fact) AS last_reading_timestamp,
        (SELECT alert_flag FROM dt ORDER BY date_actual DESC LIMIT 1) AS latest_alert_flag""")
    o["serve_score_band"] = engine_mart("""SELECT engine_id, avg_performance_score,
      CASE WHEN avg_performance_score >= 95 THEN 'green' WHEN avg_performance_score >= 85 THEN 'yellow'
           ELSE 'red' END AS score_band FROM es""")
    o["serve_series"] = with_fact(f""", lt AS ({latest})
      SELECT engine_id, reading_timestamp, 'chamber_pressure_psi' AS metric, chamber_pressure_psi AS value FROM lt
      UNION ALL SELECT engine_id, reading_timestamp, 'fuel_flow_kg_per_sec', fuel_flow_kg_per_sec FROM lt
      UNION ALL SELECT engine_id, reading_timestamp, 'temperature_fahrenheit', temperature_fahrenheit FROM lt""")
    for kind in ("not_null", "unique", "accepted_values", "unique_combination"):
        o[f"dq_{kind}"] = dq_sql([kind])
    o["dq_report"] = dq_sql(["not_null", "unique", "accepted_values", "unique_combination", "grain"])
    o["dq_failing_rows"] = _dirty_sql("SELECT test_name, failing, CAST(n AS BIGINT) AS n_records FROM fails")
    o["dq_dirty"] = _dirty_sql("""
      , names(test_name) AS (VALUES ('not_null:raw:_airbyte_raw_id'), ('not_null:raw:engine_id'), ('not_null:raw:timestamp'),
        ('unique:raw:_airbyte_raw_id'), ('unique:staging:_airbyte_raw_id'), ('unique_combination:staging:engine_id,reading_timestamp'),
        ('accepted_values:staging:engine_id'), ('not_null:staging:anomaly_type'), ('grain:staging:_airbyte_raw_id'))
      SELECT test_name, split_part(test_name, ':', 2) AS model, split_part(test_name, ':', 1) AS test_kind,
        split_part(test_name, ':', 3) AS column_name, CAST(count(failing) AS BIGINT) AS failures,
        CASE WHEN count(failing) = 0 THEN 'pass' ELSE 'fail' END AS status
      FROM names LEFT JOIN fails USING (test_name) GROUP BY test_name""")
    o["dq_fact_grain"] = with_fact("""SELECT airbyte_raw_id, CAST(count(*) AS BIGINT) AS n_records FROM fact
      GROUP BY airbyte_raw_id HAVING count(*) > 1""")
    return o
