"""Staging, fact and mart semantics on hand-made rows (every boundary both sides)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plume.operators import marts, quality, serving
from plume.operators.fact import fact_unkeyed, with_reading_key
from plume.operators.keys import global_row_number
from plume.operators.staging import staging
from plume.sources import fixtures
from plume.sources.raw import raw_load

AS_OF = dt.datetime(2025, 2, 1)


def raw_rows(spark, rows):
    """rows: (timestamp text, engine_id, p, f, t) with text measures."""
    df = spark.createDataFrame(rows, "timestamp string, engine_id string, chamber_pressure string, "
                                     "fuel_flow string, temperature string")
    return raw_load(df, AS_OF)


def stage(spark, rows):
    return {r["_airbyte_raw_id"]: r for r in staging(raw_rows(spark, rows), AS_OF).collect()}


def one(spark, p, f, t, eng="TRE-001", ts="2025-01-01T00:00:00"):
    out = list(stage(spark, [(ts, eng, p, f, t)]).values())
    return out[0] if out else None


@pytest.mark.parametrize("p,expect", [("79.999", True), ("80", False), ("400", False), ("400.001", True)])
def test_pressure_anomaly_bounds(spark, p, expect):
    assert one(spark, p, "100", "3000")["is_anomaly"] is expect


@pytest.mark.parametrize("f,expect", [("14.999", True), ("15", False), ("220", False), ("220.001", True)])
def test_fuel_anomaly_bounds(spark, f, expect):
    assert one(spark, "200", f, "3000")["is_anomaly"] is expect


@pytest.mark.parametrize("t,expect", [("1199.999", True), ("1200", False), ("4500", False), ("4500.001", True)])
def test_temperature_anomaly_bounds(spark, t, expect):
    assert one(spark, "200", "100", t)["is_anomaly"] is expect


def test_anomaly_type_first_match(spark):
    assert one(spark, "50", "10", "100")["anomaly_type"] == "LOW_PRESSURE"
    assert one(spark, "500", "10", "100")["anomaly_type"] == "HIGH_PRESSURE"
    assert one(spark, "200", "10", "100")["anomaly_type"] == "LOW_FUEL_FLOW"
    assert one(spark, "200", "300", "100")["anomaly_type"] == "HIGH_FUEL_FLOW"
    assert one(spark, "200", "100", "100")["anomaly_type"] == "LOW_TEMPERATURE"
    assert one(spark, "200", "100", "5000")["anomaly_type"] == "HIGH_TEMPERATURE"
    assert one(spark, "200", "100", "3000")["anomaly_type"] is None


@pytest.mark.parametrize("p,f,t,score", [
    ("120", "30", "1800", 100), ("350", "180", "4200", 100), ("119.999", "30", "1800", 60),
    ("350.001", "180.001", "1800", 30), ("100", "20", "4200", 30), ("100", "20", "1000", 0),
    ("200", "20", "1000", 40), ("200", "100", "1000", 70)])
def test_performance_score_bands(spark, p, f, t, score):
    assert one(spark, p, f, t)["performance_score"] == Decimal(score)


def test_efficiency_and_filters(spark):
    r = one(spark, "0", "100", "3000")
    assert r["fuel_efficiency_ratio"] is None
    assert one(spark, "200", "100", "3000")["fuel_efficiency_ratio"] == 0.5
    assert one(spark, None, "100", "3000") is None                  # NOT NULL filter
    assert one(spark, "200", "100", "3000", eng=None) is None
    assert one(spark, "200", "100", "3000", eng="")["engine_id"] == ""  # empty engine passes
    assert one(spark, "200", "100", "3000", eng=" tre-001 ")["engine_id"] == "TRE-001"
    assert one(spark, "123456.789", "100", "3000") is None           # numeric(8,3) overflow -> NULL


def _fact(spark, rows, metrics=None, engines=None):
    stg = staging(raw_rows(spark, rows), AS_OF)
    return fact_unkeyed(stg, engines or fixtures.dim_engines(spark), metrics or fixtures.dim_metrics(spark))


def test_fact_lookups_and_health(spark):
    rows = [("2025-03-04T05:06:07", "TRE-001", "200", "100", "3000"),
            ("2025-03-04T05:59:59", "tre-099", "200", "100", "3000"),
            ("2025-03-04T06:00:00", "TRE-002", "200", "20", "1000"),
            ("2025-03-04T06:00:01", "TRE-003", "100", "20", "3000")]
    f = {r["engine_id"]: r for r in _fact(spark, rows).collect()}
    assert f["TRE-001"]["engine_key"] == 1           # current version, not the old key 6
    assert f["TRE-099"]["engine_key"] == -1
    assert f["TRE-001"]["time_key"] == 2025030405
    assert (f["TRE-001"]["pressure_metric_key"], f["TRE-001"]["fuel_flow_metric_key"],
            f["TRE-001"]["temperature_metric_key"]) == (1, 2, 3)
    assert f["TRE-001"]["health_status"] == "EXCELLENT" and not f["TRE-001"]["is_out_of_normal_range"]
    assert f["TRE-002"]["health_status"] == "FAIR" and f["TRE-002"]["is_out_of_normal_range"]
    assert f["TRE-003"]["health_status"] == "POOR"


def test_fact_with_empty_or_partial_metrics(spark):
    rows = [("2025-03-04T05:06:07", "TRE-001", "100", "100", "3000")]
    empty = fixtures.empty_like(spark, fixtures.dim_metrics(spark).schema)
    r = _fact(spark, rows, metrics=empty).collect()
    assert len(r) == 1 and r[0]["pressure_metric_key"] == -1 and r[0]["is_out_of_normal_range"] is False
    partial = fixtures.dim_metrics(spark, names=("fuel_flow",))
    r = _fact(spark, rows, metrics=partial).collect()[0]
    assert (r["pressure_metric_key"], r["fuel_flow_metric_key"]) == (-1, 2)
    assert r["is_out_of_normal_range"] is False       # pressure 100 is out of 150-300 but no threshold


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_reading_key_partition_invariant(spark, parts, tmp_dir):
    rows = [(f"2025-03-0{1 + i % 3}T0{i % 4}:00:{i % 60:02d}", f"TRE-00{1 + i % 5}", "200", "100", "3000")
            for i in range(300)]
    f = _fact(spark, rows).repartition(parts)
    keyed = with_reading_key(f, num_partitions=parts, workdir=tmp_dir).collect()
    keys = sorted(r["reading_key"] for r in keyed)
    assert keys == list(range(1, 301))
    ordered = sorted(keyed, key=lambda r: (r["time_key"], r["engine_key"], r["reading_timestamp"],
                                           r["airbyte_raw_id"]))
    assert [r["reading_key"] for r in ordered] == list(range(1, 301))


def test_global_row_number_hot_key(spark, tmp_dir):
    """One key value holds most rows: still a dense 1..N numbering in order."""
    df = spark.range(2000).select(F.when(F.col("id") < 1500, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("u"))
    out = global_row_number(df, ["k", "u"], "rn", num_partitions=8, workdir=tmp_dir).orderBy("rn").collect()
    assert [r["rn"] for r in out] == list(range(1, 2001))
    assert [(r["k"], r["u"]) for r in out] == sorted((r["k"], r["u"]) for r in out)


def _mart_fact(spark, per_engine):
    rows = []
    for eng, vals in per_engine.items():
        for i, (p, f, t) in enumerate(vals):
            rows.append((f"2025-01-0{1 + i % 9}T00:00:{i:02d}", eng, p, f, t))
    return _fact(spark, rows)


def test_engine_summary_rules(spark):
    fact = _mart_fact(spark, {
        "TRE-001": [("200", "100", "3000")] * 19 + [("50", "100", "3000")],        # 5.00% EXCELLENT
        "TRE-002": [("200", "100", "3000")] * 17 + [("50", "100", "3000")] * 3,    # 15.00% GOOD
        "TRE-003": [("0", "100", "3000")] * 2,                                     # all pressures 0
        "TRE-077": [("200", "100", "3000")],                                       # single row
    })
    s = {r["engine_id"]: r for r in marts.engine_summary(fact, AS_OF).collect()}
    assert s["TRE-001"]["anomaly_rate_percent"] == Decimal("5.00") and s["TRE-001"]["health_status"] == "EXCELLENT"
    assert s["TRE-002"]["health_status"] == "GOOD"
    assert s["TRE-003"]["health_status"] == "NEEDS_ATTENTION"
    assert s["TRE-003"]["avg_fuel_efficiency_ratio"] is None
    assert s["TRE-003"]["efficiency_rank"] == 1              # NULL first in DESC rank
    assert s["TRE-077"]["stddev_chamber_pressure"] is None   # one row -> NULL stddev
    assert s["TRE-077"]["engine_name"] == "TRE-077 (Unknown)"
    assert s["TRE-001"]["engine_name"].endswith("Alpha")
    assert s["TRE-001"]["pressure_utilization_percent"] == Decimal("55.00")  # avg 192.5 / 350
    assert s["TRE-001"]["burn_phase_readings"] == s["TRE-001"]["total_readings"] == 20


def test_daily_trends_rules(spark):
    rows = []
    # 10 days, day 3 missing (row-based lags), rising anomalies on the last day
    days = [1, 2, 4, 5, 6, 7, 8, 9, 10, 11]
    for d in days:
        n_anom = 1 if d < 11 else 8
        for i in range(10):
            p = "50" if i < n_anom else "200"
            rows.append((f"2025-01-{d:02d}T10:00:{i:02d}", "TRE-001", p, "100", "3000"))
    t = {r["date_actual"].day: r for r in marts.daily_trends(_fact(spark, rows), AS_OF).collect()}
    assert t[11]["daily_anomaly_rate_percent"] == Decimal("80.00")
    assert t[11]["week_ago_anomaly_rate"] == t[4]["daily_anomaly_rate_percent"]   # 7 rows back, not days
    assert t[11]["anomaly_trend"] == "DETERIORATING"
    assert t[11]["alert_flag"] == "HIGH_ANOMALY_ALERT"
    assert t[5]["anomaly_trend"] == "STABLE"
    assert t[4]["day_of_week"] == 6 and t[4]["is_weekend"]       # 2025-01-04 is a Saturday
    assert t[1]["prev_day_anomaly_rate"] is None
    assert t[11]["critical_readings"] == 0 and t[11]["poor_readings"] == 0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, v string")
    assert quality.not_null(df, "k").count() == 1
    assert [r["k"] for r in quality.unique(df, "k").collect()] == [1]
    assert quality.accepted_values(df, "v", ("a", "b")).count() == 1     # NULL passes
    assert quality.unique_combination(df, ["k"]).count() == 1


def test_q3_equals_literal_cross_join(spark):
    rows = [(f"2025-01-0{1 + i % 3}T00:00:{i:02d}", f"TRE-00{1 + i % 2}", str(100 + i), str(50 + i), "3000")
            for i in range(30)]
    fact = _fact(spark, rows)
    engines, metrics = fixtures.dim_engines(spark), fixtures.dim_metrics(spark)
    fast = {(r[0], r[1], r[2]): (r[3], r[4]) for r in serving.q3_metric_matrix(fact, engines, metrics).collect()}
    lit = (fact.join(engines, "engine_key").crossJoin(metrics)
           .groupBy(engines["engine_id"], F.to_date("reading_timestamp").alias("d"), "metric_category")
           .agg(F.avg(F.when(F.col("metric_name") == "chamber_pressure", F.col("chamber_pressure_psi"))).alias("p"),
                F.avg(F.when(F.col("metric_name") == "fuel_flow", F.col("fuel_flow_kg_per_sec"))).alias("f")))
    slow = {(r[0], r[1], r[2]): (r[3], r[4]) for r in lit.collect()}
    assert fast.keys() == slow.keys()
    for k in fast:
        for a, b in zip(fast[k], slow[k]):
            assert (a is None and b is None) or abs(float(a) - float(b)) < 1e-6


def test_dimension_defaults_and_bridge(spark):
    from plume.operators.dims import current_engines, metric_lookup, with_engine_defaults
    from plume.schemas import DIM_ENGINES_SCHEMA
    bare = spark.createDataFrame([(9, "TRE-009") + (None,) * 15], DIM_ENGINES_SCHEMA)
    r = with_engine_defaults(bare).collect()[0]
    assert (r["engine_type"], r["max_chamber_pressure_psi"], r["max_fuel_flow_kg_per_sec"],
            r["max_temperature_fahrenheit"], r["operational_status"], r["is_current"],
            r["source_system"]) == ("Rocket Engine", 350, 200, 4000, "ACTIVE", True, "MANUAL")
    assert str(r["effective_to_date"]) == "2999-12-31"
    eng = fixtures.dim_engines(spark)
    assert sorted(r["engine_key"] for r in current_engines(eng).collect()) == [1, 2, 3, 4, 5]
    bridge = fixtures.bridge_engine_metrics(eng, fixtures.dim_metrics(spark)).collect()
    assert len(bridge) == 15 and {float(b["calibration_factor"]) for b in bridge} == {1.0}
    lk = metric_lookup(fixtures.dim_metrics(spark)).collect()
    assert len(lk) == 1 and lk[0]["pressure_metric_key"] == 1 and float(lk[0]["temperature_normal_max"]) == 4000


def test_store_test_failures(spark, tmp_dir):
    import os
    df = spark.createDataFrame([(1, "EXCELLENT"), (1, "BAD"), (None, "GOOD")],
                               "engine_id int, health_status string")
    tests = [quality.Test("engine_summary", "not_null", "engine_id"),
             quality.Test("engine_summary", "unique", "engine_id"),
             quality.Test("engine_summary", "accepted_values", "health_status", ("EXCELLENT", "GOOD"))]
    paths = quality.store_test_failures({"engine_summary": df}, os.path.join(tmp_dir, "failures"), tests)
    counts = {k: spark.read.parquet(v).count() for k, v in paths.items()}
    assert counts == {"not_null:engine_summary:engine_id": 1, "unique:engine_summary:engine_id": 1,
                      "accepted_values:engine_summary:health_status": 1}
    summary = {r["test_name"]: r["failures"] for r in quality.run_declared_tests({"engine_summary": df}, tests).collect()}
    assert summary == counts


def test_recent_anomalies_filter_after_limit(spark):
    # 60 readings, one per minute; only the 10 oldest are anomalous
    rows = [(f"2025-01-01T{i // 60:02d}:{i % 60:02d}:00", "TRE-001", "50" if i < 10 else "200", "100", "3000")
            for i in range(60)]
    fact = _fact(spark, rows)
    latest = serving.latest_readings(fact)
    assert latest.count() == 50
    assert serving.recent_anomalies(latest).count() == 0          # not "the 10 latest anomalies"
    rows2 = rows + [("2025-01-01T02:00:00", "TRE-002", "50", "100", "3000")]
    got = serving.recent_anomalies(serving.latest_readings(_fact(spark, rows2))).collect()
    assert [r["engine_id"] for r in got] == ["TRE-002"]


def test_q1_pre_aggregation_equals_join_then_aggregate_with_fan_out(spark):
    from pyspark.sql import functions as F
    rows = [(f"2025-01-0{1 + i % 3}T00:00:{i:02d}", f"TRE-00{1 + i % 3}", str(100 + i), str(40 + i), "3000")
            for i in range(40)]
    fact = _fact(spark, rows)
    eng = fixtures.dim_engines(spark)
    # a second row for engine key 2 (a duplicated dimension key fans the join out)
    dup = eng.where("engine_key = 2").withColumn("engine_id", F.lit("TRE-002-dup"))
    dims = eng.unionByName(dup)
    fast = {r["engine_id"]: (r["avg_pressure"], r["avg_efficiency"], r["total_readings"])
            for r in serving.q1_engine_comparison(fact, dims).collect()}
    lit = (fact.join(dims, "engine_key").groupBy(dims["engine_id"])
           .agg(F.avg("chamber_pressure_psi").alias("p"), F.avg("fuel_efficiency_ratio").alias("e"),
                F.count(F.lit(1)).alias("n")))
    slow = {r[0]: (r[1], r[2], r[3]) for r in lit.collect()}
    assert fast.keys() == slow.keys()
    for k in slow:
        assert abs(float(fast[k][0]) - float(slow[k][0])) < 1e-6
        assert abs(fast[k][1] - slow[k][1]) < 1e-12
        assert fast[k][2] == slow[k][2]


def test_batch_models_ignore_session_time_zone(spark):
    rows = [("2025-03-04T05:06:07", "TRE-001", "200", "100", "3000"),
            ("2025-03-04T23:59:59.5", "TRE-002", "50", "100", "3000")]

    def snapshot():
        f = _fact(spark, rows).collect()
        d = marts.daily_trends(_fact(spark, rows), AS_OF).collect()
        return (sorted((r["reading_timestamp"], r["time_key"], r["created_at"]) for r in f),
                sorted((r["date_actual"], r["day_of_week"], r["report_generated_at"]) for r in d))

    base = snapshot()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("Asia/Kolkata", "America/Los_Angeles", "Pacific/Chatham"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert snapshot() == base, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base[0][0][2] == AS_OF
