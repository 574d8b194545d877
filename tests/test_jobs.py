"""The end-to-end batch job on generated telemetry."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from plume.plans.jobs import run_batch
from plume.sources import fixtures
from tests.tools import generator


def test_run_batch_end_to_end(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    rows = [r["value"] for r in generator.generate_jsonl(spark, 4000, seed=5).orderBy("_ord").collect()]
    os.makedirs(src)
    with open(os.path.join(src, "part-0.jsonl"), "w") as f:
        f.write("# generated\n" + "\n".join(rows) + "\n{broken\n")
    out = os.path.join(tmp_dir, "out")
    res = run_batch(spark, src, out, fixtures.dim_engines(spark), fixtures.dim_metrics(spark),
                    as_of=dt.datetime(2025, 2, 1), table_prefix="e2e")
    assert not os.path.exists(os.path.join(out, "work"))
    s = res["summary"]
    assert s["parsing_errors"] == 1
    assert s["total_records"] == len(rows)
    assert s["total_records"] == s["valid_records"] + s["dropped_records"]
    assert s["duplicate_records"] > 0
    assert res["failed_tests"] == []
    assert spark.table("e2e_fact").count() == spark.read.parquet(os.path.join(out, "tables", "fact")).count()
    assert spark.table("e2e_engine_summary").count() == 5
    assert os.path.isdir(os.path.join(out, "test_results"))


def _landing(tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        for i in range(20):
            f.write('{"timestamp": "2025-01-01T00:00:%02d", "engine_id": "TRE-00%d", "chamber_pressure": 200, '
                    '"fuel_flow": 100, "temperature": 3000}\n' % (i, 1 + i % 4))
    return src


def test_dimensions_are_inputs(spark, tmp_dir):
    """Old versions never match, a missing metric leaves its key unknown, defaults are filled in."""
    engines = fixtures.dim_engines(spark).where("engine_id <> 'TRE-002'").drop("manufacturer")
    metrics = fixtures.dim_metrics(spark, ["chamber_pressure", "fuel_flow"])
    run_batch(spark, _landing(tmp_dir), os.path.join(tmp_dir, "o"), engines, metrics, as_of=dt.datetime(2025, 2, 1), table_prefix="dims")
    fact = spark.table("dims_fact")
    assert {(r.engine_id, r.engine_key) for r in fact.select("engine_id", "engine_key").distinct().collect()} == {
        ("TRE-001", 1), ("TRE-002", -1), ("TRE-003", 3), ("TRE-004", 4)}
    assert [tuple(r) for r in fact.select("pressure_metric_key", "temperature_metric_key").distinct().collect()] == [(1, -1)]


def test_dimension_keys_that_would_fan_out_stop_the_job(spark, tmp_dir):
    engines, metrics = fixtures.dim_engines(spark), fixtures.dim_metrics(spark)
    src = _landing(tmp_dir)
    for e, m in ((engines.withColumn("is_current", F.lit(True)), metrics), (engines.withColumn("engine_key", F.lit(1)), metrics),
                 (engines, metrics.withColumn("metric_name", F.lit("fuel_flow"))), (engines, metrics.unionByName(metrics))):
        with pytest.raises(ValueError):
            run_batch(spark, src, os.path.join(tmp_dir, "x"), e, m)
