import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plume.operators.history import END_OF_TIME, calibrated, merge_versions, valid_at
from plume.operators.keys import global_ranks
from plume.schemas import BRIDGE_SCHEMA, DIM_ENGINES_SCHEMA
from plume.sources import fixtures

D1, D2, D3 = dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 1, 30)


def delivery(spark, *rows):
    return spark.createDataFrame(list(rows), "engine_id string, operational_status string, max_temperature_fahrenheit int")


def versions(history):
    return sorted((r.engine_id, r.operational_status, r.effective_from_date, r.effective_to_date, r.is_current, r.engine_key)
                  for r in history.collect())


def test_versions_follow_one_another(spark, tmp_dir):
    h = fixtures.empty_like(spark, DIM_ENGINES_SCHEMA)
    h = merge_versions(h, delivery(spark, ("A", "ACTIVE", None), ("B", "ACTIVE", 3900)), D1, workdir=tmp_dir)
    assert versions(h) == [("A", "ACTIVE", D1, END_OF_TIME, True, 1), ("B", "ACTIVE", D1, END_OF_TIME, True, 2)]
    assert h.where("engine_id = 'A'").first().max_temperature_fahrenheit == 4000                 # the default
    again = merge_versions(h, delivery(spark, ("A", "ACTIVE", 4000), ("B", "ACTIVE", 3900)), D2, workdir=tmp_dir)
    assert versions(again) == versions(h)                                                        # nothing changed
    h = merge_versions(again, delivery(spark, ("A", "RETIRED", None), ("C", None, None)), D2, workdir=tmp_dir)
    day = dt.timedelta(days=1)
    want = [("A", "ACTIVE", D1, D2 - day, False, 1), ("A", "RETIRED", D2, END_OF_TIME, True, 3),
            ("B", "ACTIVE", D1, END_OF_TIME, True, 2), ("C", "ACTIVE", D2, END_OF_TIME, True, 4)]
    assert versions(h) == want
    assert versions(merge_versions(h, delivery(spark, ("A", "RETIRED", None), ("C", None, None)), D2, workdir=tmp_dir)) == want
    # a correction on the day a version began replaces it
    h = merge_versions(h, delivery(spark, ("A", "TEST", None)), D2, workdir=tmp_dir)
    assert versions(h)[1] == ("A", "TEST", D2, END_OF_TIME, True, 3) and len(versions(h)) == 4
    # a full delivery closes what it lacks; what began that day leaves no empty interval
    full = merge_versions(h, delivery(spark, ("B", "ACTIVE", 3900)), D2, full=True, workdir=tmp_dir)
    assert versions(full) == [("A", "ACTIVE", D1, D2 - day, False, 1), ("B", "ACTIVE", D1, END_OF_TIME, True, 2)]
    later = merge_versions(h, delivery(spark, ("B", "ACTIVE", 3900)), D3, full=True, workdir=tmp_dir)
    assert [v[3:5] for v in versions(later)] == [(D2 - day, False), (D3 - day, False), (END_OF_TIME, True), (D3 - day, False)]


def test_bad_deliveries_stop(spark, tmp_dir):
    h = merge_versions(fixtures.empty_like(spark, DIM_ENGINES_SCHEMA), delivery(spark, ("A", "ACTIVE", None)), D2, workdir=tmp_dir)
    with pytest.raises(ValueError, match="occurs 2 times"):
        merge_versions(h, delivery(spark, ("A", "X", 1), ("A", "Y", 2)), D3, workdir=tmp_dir)
    with pytest.raises(ValueError, match="begins on 2024-01-20"):
        merge_versions(h, delivery(spark, ("A", "X", 1)), D1, workdir=tmp_dir)
    with pytest.raises(ValueError):
        merge_versions(h, delivery(spark, (None, "X", 1)), D3, workdir=tmp_dir)
    assert versions(merge_versions(h, delivery(spark), D3, workdir=tmp_dir)) == versions(h)


def test_each_reading_gets_the_version_valid_then(spark, tmp_dir):
    h = fixtures.empty_like(spark, DIM_ENGINES_SCHEMA)
    for day, status in ((D1, "ACTIVE"), (D2, "MAINTENANCE"), (D3, "ACTIVE")):
        h = merge_versions(h, delivery(spark, ("A", status, None)), day, workdir=tmp_dir)
    readings = spark.sql("SELECT * FROM VALUES (1, 'A', timestamp_ntz'2024-01-09 23:59:59'), (2, 'A', timestamp_ntz'2024-01-10 00:00:00'),"
                         "(3, 'A', timestamp_ntz'2024-01-19 23:59:59.999999'), (4, 'A', timestamp_ntz'2024-01-20 00:00:00'),"
                         "(5, 'A', timestamp_ntz'2025-01-01 00:00:00'), (6, 'Z', timestamp_ntz'2024-01-15 00:00:00'),"
                         "(7, NULL, timestamp_ntz'2024-01-15 00:00:00'), (8, 'A', NULL) t(i, engine_id, reading_timestamp)")
    got = {r.i: (r.engine_key, r.operational_status) for r in valid_at(readings, h, ("engine_key", "operational_status")).collect()}
    assert got == {1: (None, None), 2: (1, "ACTIVE"), 3: (1, "ACTIVE"), 4: (2, "MAINTENANCE"), 5: (3, "ACTIVE"),
                   6: (None, None), 7: (None, None), 8: (None, None)}


def test_calibration_keeps_one_row_per_reading(spark):
    metrics = fixtures.dim_metrics(spark)
    bridge = spark.createDataFrame([(1, 1, Decimal("1.100000"), "s"), (1, 2, None, "s"), (2, 3, Decimal("0.333333"), "s"),
                                    (2, 99, Decimal("9.0"), "s")], BRIDGE_SCHEMA)
    readings = spark.sql("SELECT id, k AS engine_key, cast(p AS decimal(8,3)) chamber_pressure_psi, cast(10.5 AS decimal(8,3))"
                         " fuel_flow_kg_per_sec, cast(t AS decimal(8,3)) temperature_fahrenheit FROM VALUES (1, 1, 200.005, 3000),"
                         "(2, 2, 200, 99999.999), (3, -1, 1, 1), (4, NULL, 1, NULL) t(id, k, p, t)")
    out = {r.id: tuple(r)[5:] for r in calibrated(readings, bridge, metrics).collect()}
    assert out == {1: (Decimal("220.006"), Decimal("10.500"), Decimal("3000.000")),
                   2: (Decimal("200.000"), Decimal("10.500"), Decimal("33333.300")),
                   3: (Decimal("1.000"), Decimal("10.500"), Decimal("1.000")), 4: (Decimal("1.000"), Decimal("10.500"), None)}
    with pytest.raises(ValueError, match="occurs 2 times"):
        calibrated(readings, bridge.unionByName(bridge), metrics)


def test_global_ranks_equal_the_window_at_a_million_ids(spark, tmp_dir):
    df = spark.range(1_000_000).select(
        "id", F.when(F.col("id") % 11 > 0, F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1000)).cast("decimal(9,2)").alias("a"),
        F.when(F.col("id") % 7 > 0, (F.xxhash64("id", F.lit(1)) % 100000) / 8).alias("b"))
    specs = [("ra", "a", True), ("rb", "b", False), ("rc", F.round("b", 0), True)]
    path = f"{tmp_dir}/in"
    df.write.parquet(path)
    got = global_ranks(spark.read.parquet(path), specs, num_partitions=7, workdir=tmp_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    want = df.select("id", F.rank().over(Window.orderBy(F.col("a").desc_nulls_first())).alias("ra"),
                     F.rank().over(Window.orderBy(F.col("b").asc_nulls_last())).alias("rb"),
                     F.rank().over(Window.orderBy(F.round("b", 0).desc_nulls_first())).alias("rc"))
    assert got.select("id", "ra", "rb", "rc").exceptAll(want).isEmpty() and got.count() == 1_000_000


def test_global_ranks_of_no_rows_and_equal_rows(spark, tmp_dir):
    none = spark.createDataFrame([], "x double")
    assert global_ranks(none, [("r", "x", True)], workdir=tmp_dir).collect() == []
    rows = spark.createDataFrame([(None,), (0.0,), (-0.0,), (float("nan"),), (None,), (2.0,)], "x double")
    got = sorted((r.r, str(r.x)) for r in global_ranks(rows, [("r", "x", True)], workdir=tmp_dir).collect())
    assert [r for r, _ in got] == [1, 1, 3, 4, 5, 5]
