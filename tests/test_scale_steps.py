"""Steps that every query over the lines shares, at the size of their work rather than of their rows."""

import contextlib
import datetime as dt
import io
import re

from pyspark.sql import functions as F

from plume.operators import ingest, quality
from plume.plans import registry
from plume.plans.pipeline import Pipeline
from plume.sources import fixtures
from plume.sources.text import numbered_lines, read_jsonl
from plume.streaming import streams


def _events(spark, n):
    return spark.range(n, numPartitions=3).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("ts"))


def _code_sizes(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("codegen")
    return [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


def test_lines_are_made_by_methods_that_the_jvm_compiles(spark):
    """Beyond 8,000 bytes a method stays interpreted, at five times the cost."""
    made = fixtures.jsonl_from_events(_events(spark, 10))
    assert max(_code_sizes(made)) < 8000
    assert max(_code_sizes(made.where("part = 0").select("value"))) < 8000


def test_numbered_lines_follow_files_and_splits(spark, tmp_dir):
    """numbers without a sort of the lines, over several folders and splits."""
    for folder, first in (("0", 0), ("1", 5000)):
        spark.range(first, first + 5000, numPartitions=3).select(F.col("id").cast("string")).write.text(f"{tmp_dir}/{folder}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = numbered_lines(read_jsonl(spark, [f"{tmp_dir}/0", f"{tmp_dir}/1"]), tmp_dir)
        assert lines.count() == 10000 and lines.where(F.col("value") != F.col("_ord") - 1).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lines_keep_the_order_of_events(spark, tmp_dir):
    """input order is (part, event_id), whatever the order of the table."""
    _events(spark, 3000).orderBy(F.desc("event_id")).write.parquet(f"{tmp_dir}/events.parquet")
    got = [r[0] for r in Pipeline(spark, tmp_dir, workdir=tmp_dir).lines.orderBy("_ord").select("value").collect()]
    want = fixtures.jsonl_from_events(spark.read.parquet(f"{tmp_dir}/events.parquet")).orderBy("part", "event_id")
    assert got == [r[0] for r in want.select("value").collect()]


def test_dirty_models_parse_once(spark, tmp_dir):
    """the tests read stored records and not, each of them, the lines."""
    _events(spark, 3000).write.parquet(f"{tmp_dir}/events.parquet")
    models = registry._dirty_models(Pipeline(spark, tmp_dir, workdir=tmp_dir))
    for df in models.values():
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        assert "from_json" not in out.getvalue()
    assert quality.run_declared_tests(models, quality.DIRTY_TESTS).where("failures > 0").count() > 0


def test_batch_is_evaluated_once(spark, tmp_dir):
    """a micro-batch's rows pass its parse and state once."""
    n = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    text = "timestamp string, engine_id string, chamber_pressure string, fuel_flow string, temperature string"
    rows = [(f"2024-01-01T00:00:{i:02d}", "TRE-001", "200", "100", "3000") for i in range(40)]
    batch = spark.createDataFrame(rows, text).mapInArrow(seen, text)
    refresher = streams.MartRefresher(spark, f"{tmp_dir}/marts", fixtures.dim_engines(spark), fixtures.dim_metrics(spark),
                                      as_of=dt.datetime(2024, 2, 1))
    refresher(batch, 0)
    assert refresher.fact().count() == 40 and n.value == 40


def test_events_of_records_that_log_nothing(spark):
    """a record without events gives its one row, and others keep theirs."""
    good = '{"timestamp": "2024-01-01T00:00:00", "engine_id": "E", "chamber_pressure": %s, "fuel_flow": 1, "temperature": %s}'
    values = [good % (5, 10), good % (-5, 7000), good % (5, '"x"'), good % ("null", 10), "# note", "", "{", "5"]
    lines = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, _ord long")
    got = ingest.classified_rows(lines).groupBy("_ord").agg(F.array_sort(F.collect_list(
        F.concat_ws(":", "output", "rule"))).alias("rows")).collect()
    assert {r["_ord"]: r["rows"] for r in got} == {
        0: ["valid"], 1: ["event:high_temperature_warning", "event:negative_pressure_corrected", "valid"],
        2: ["dropped:bad_numeric_temperature", "event:bad_numeric"],
        3: ["dropped:bad_numeric_chamber_pressure", "event:bad_numeric"],
        6: ["broken:parse_error"], 7: ["dropped:missing_required", "event:missing_required"]}
