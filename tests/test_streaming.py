"""Streaming (K1-K4) equals batch on the same files."""

import os

from pyspark.sql import functions as F

from plume.operators import ingest
from plume.sources import fixtures
from plume.streaming import streams
from tests.tools import generator


def _write_lines(spark, path, lines_df, name):
    rows = [r["value"] for r in lines_df.orderBy("_ord").collect()]
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(rows) + "\n")


def test_stream_clean_dedup_hourly_equal_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    gen = generator.generate_jsonl(spark, 3000, seed=11)
    _write_lines(spark, src, gen, "part-000.jsonl")
    # sentinel file, read in a later micro-batch: closes every earlier window
    sentinel = '{"timestamp": "2026-01-01T00:00:00", "engine_id": "TRE-001", ' \
               '"chamber_pressure": 200, "fuel_flow": 100, "temperature": 3000}'
    with open(os.path.join(src, "part-001.jsonl"), "w") as f:
        f.write(sentinel + "\n")

    lines = streams.read_lines_stream(spark, src, max_files_per_trigger=1)
    validated = streams.clean_stream(lines)
    deduped = streams.dedup_stream(validated, "10 minutes")
    out_clean = os.path.join(tmp_dir, "clean")
    q = streams.start_to_table(deduped.drop("_event_time"), out_clean, os.path.join(tmp_dir, "ck1"))
    q.awaitTermination(120)
    hourly = streams.hourly_anomalies_stream(streams.dedup_stream(streams.clean_stream(
        streams.read_lines_stream(spark, src, max_files_per_trigger=1)), "10 minutes"))
    out_hourly = os.path.join(tmp_dir, "hourly")
    q2 = streams.start_to_table(hourly, out_hourly, os.path.join(tmp_dir, "ck2"))
    q2.awaitTermination(120)

    batch_lines = spark.read.text(src).select("value", F.monotonically_increasing_id().alias("_ord"))
    batch_clean = ingest.clean_lines(batch_lines)
    got = spark.read.parquet(out_clean)
    key = ["timestamp", "engine_id"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, batch_clean.select(key).collect()))

    h = {r["window_start"]: (r["anomaly_count"], r["total_readings"]) for r in spark.read.parquet(out_hourly).collect()}
    from plume.operators.staging import staging
    from plume.sources.raw import raw_load
    stg = staging(raw_load(batch_clean, "2025-01-01T00:00:00"))
    expect = {r[0]: (r[1], r[2]) for r in stg.groupBy(F.date_trunc("hour", "reading_timestamp").alias("w"))
              .agg(F.count_if("is_anomaly"), F.count(F.lit(1))).collect()}
    sentinel_hour = max(expect)
    del expect[sentinel_hour]
    assert h == expect


def test_foreach_batch_marts(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = fixtures.jsonl_from_events(ev)
    lines = lines.where("part = 0").withColumnRenamed("event_id", "_ord")
    _write_lines(spark, src, lines.where(F.col("_ord") < 500), "a.jsonl")
    _write_lines(spark, src, lines.where(F.col("_ord") >= 500), "b.jsonl")
    base = os.path.join(tmp_dir, "marts")
    refresher = streams.MartRefresher(spark, base, fixtures.dim_engines(spark), fixtures.dim_metrics(spark))
    v = streams.clean_stream(streams.read_lines_stream(spark, src, max_files_per_trigger=1))
    deduped = streams.dedup_stream(v, "40 days")      # the fixture spans 30 days
    q = (deduped.writeStream.foreachBatch(refresher)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(180)
    daily = {r["date_actual"]: r for r in refresher.read("daily_trends").collect()}
    engines = {r["engine_id"]: r for r in refresher.read("engine_summary").collect()}
    # batch reference over the same lines (no duplicates across the two files here)
    from plume.operators import marts
    from plume.operators.fact import fact_unkeyed
    from plume.operators.staging import staging
    from plume.sources.raw import raw_load
    from plume.sources.text import read_jsonl
    clean = ingest.clean_lines(read_jsonl(spark, src))        # input order = file path, then position
    fact = fact_unkeyed(staging(raw_load(clean, "2025-01-01T00:00:00")), fixtures.dim_engines(spark),
                        fixtures.dim_metrics(spark))
    bd = {r["date_actual"]: r for r in marts.daily_trends(fact).collect()}
    be = {r["engine_id"]: r for r in marts.engine_summary(fact).collect()}
    assert daily.keys() == bd.keys()
    for d in bd:
        for c in ("total_readings", "total_anomalies", "daily_anomaly_rate_percent", "active_engines",
                  "critical_readings", "alert_flag"):
            assert daily[d][c] == bd[d][c], (d, c)
    assert engines.keys() == be.keys()
    for e in be:
        for c in ("total_readings", "anomaly_rate_percent", "health_status", "performance_rank"):
            assert engines[e][c] == be[e][c], (e, c)
        assert abs(float(engines[e]["avg_chamber_pressure_psi"]) - float(be[e]["avg_chamber_pressure_psi"])) < 1e-6
        for c in ("stddev_temperature", "stddev_chamber_pressure", "stddev_fuel_flow"):
            if be[e][c] is not None:
                assert abs(engines[e][c] - be[e][c]) < 1e-9 * max(1.0, be[e][c]), (e, c)
    for d in bd:
        if bd[d]["stddev_daily_performance"] is not None:
            assert abs(daily[d]["stddev_daily_performance"] - bd[d]["stddev_daily_performance"]) < 1e-9


def test_stream_observed_counts(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    lines = ['{"timestamp": "2025-01-01T00:00:00", "engine_id": "TRE-001", "chamber_pressure": -5, '
             '"fuel_flow": 100, "temperature": 3000}',
             '{"timestamp": "bad", "engine_id": "TRE-001"}', "{oops", "", "# c"]
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")
    v = streams.observe_counts(streams.clean_stream(streams.read_lines_stream(spark, src)))
    q = streams.start_to_table(streams.valid_stream(v), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    progress = [p for p in q.recentProgress if p.get("observedMetrics")]
    m = progress[-1]["observedMetrics"]["plume_ingest"]
    assert (m["total_records"], m["parsing_errors"], m["valid_records"], m["corrected_records"]) == (2, 1, 1, 1)


def test_mart_refresher_batch_retry_is_idempotent(spark, tmp_dir):
    import datetime as dt
    rows = [(f"2025-01-0{1 + i % 3}T00:00:{i:02d}", f"TRE-00{1 + i % 5}", "200", "100", "3000") for i in range(30)]
    batch = spark.createDataFrame(rows, "timestamp string, engine_id string, chamber_pressure string, "
                                        "fuel_flow string, temperature string")
    base = os.path.join(tmp_dir, "marts")
    r = streams.MartRefresher(spark, base, fixtures.dim_engines(spark), fixtures.dim_metrics(spark),
                              as_of=dt.datetime(2025, 2, 1))
    r(batch, 0)
    r(batch, 0)            # the same micro-batch again, as after a failure
    assert r.fact().count() == 30
    daily = r.read("daily_trends").agg(F.sum("total_readings")).collect()[0][0]
    assert daily == 30
    r(batch.limit(3).withColumn("timestamp", F.lit("2025-01-04T00:00:00")), 1)
    assert r.fact().count() == 33   # dedup happens upstream of the refresher


def _batch(spark, days, n=30):
    rows = [(f"2025-01-{days[i % len(days)]:02d}T00:00:{i:02d}", f"TRE-00{1 + i % 5}", str(200 + i), "100", "3000") for i in range(n)]
    return spark.createDataFrame(rows, "timestamp string, engine_id string, chamber_pressure string, fuel_flow string, "
                                       "temperature string")


def test_a_crash_at_any_step_loses_no_history(spark, tmp_dir, monkeypatch):
    import datetime as dt

    from plume.operators import marts
    args = (fixtures.dim_engines(spark), fixtures.dim_metrics(spark), dt.datetime(2025, 2, 1))
    steps = ("_append", "partials", "merge_partials", "engine_summary_from_partials", "daily_trends_from_partials", "_commit", "_prune")
    for k, step in enumerate(steps):
        r = streams.MartRefresher(spark, os.path.join(tmp_dir, f"m{k}"), *args)
        r(_batch(spark, [1, 2, 3]), 0)
        owner = streams if not step.startswith("_") else streams.MartRefresher
        real = getattr(owner, step)

        def dies(*a, real=real, step=step):
            if step in ("_append", "_prune"):
                real(*a)                      # the work is done, what follows is not
            raise OSError("killed")

        with monkeypatch.context() as m:
            m.setattr(owner, step, dies)
            try:
                r(_batch(spark, [3, 4]), 1)
            except OSError:
                pass
            else:
                raise AssertionError(step)
        r(_batch(spark, [3, 4]), 1)           # the retry
        assert [x[0] for x in r.fact().select("reading_key").orderBy("reading_key").collect()] == list(range(1, 61)), step
        assert r.fact().count() == 60, step
        daily = {x.date_actual.day: x.total_readings for x in r.read("daily_trends").collect()}
        assert daily == {1: 10, 2: 10, 3: 25, 4: 15}, step
        want = {x.engine_id: x for x in marts.engine_summary(r.fact(), dt.datetime(2025, 2, 1)).collect()}
        got = {x.engine_id: x for x in r.read("engine_summary").collect()}
        assert got.keys() == want.keys()
        for e in want:
            for c in want[e].asDict():
                a, b = got[e][c], want[e][c]
                assert a == b or (isinstance(b, float) and abs(a - b) < 1e-9 * max(1, abs(b))), (step, e, c, a, b)


def test_folders_do_not_grow_with_batches(spark, tmp_dir):
    import datetime as dt
    r = streams.MartRefresher(spark, os.path.join(tmp_dir, "m"), fixtures.dim_engines(spark), fixtures.dim_metrics(spark),
                              dt.datetime(2025, 2, 1))
    for b in range(5):
        r(_batch(spark, [1, 2], 10), b)
    assert r.fact().count() == 50
    assert sorted(x for x in os.listdir(r.fact_path) if x.startswith("reading_date")) == [
        "reading_date=2025-01-01", "reading_date=2025-01-02"]
    assert len(os.listdir(os.path.join(r.base, "versions"))) == 2
    assert len([x for x in os.listdir(os.path.join(r.base, "commits")) if not x.startswith((".", "_"))]) == 2


def _three_files(tmp_dir, extra):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    line = '{{"timestamp": "{}", "engine_id": "TRE-001", "chamber_pressure": 200, "fuel_flow": {}, "temperature": 3000}}\n'
    for i in range(3):
        with open(os.path.join(src, f"{i}.jsonl"), "w") as f:
            f.write("".join(line.format(f"2025-01-01T0{i}:0{k}:00", 100) for k in range(2)))
            if i == 0:
                f.write(line.format(*extra))
        os.utime(os.path.join(src, f"{i}.jsonl"), (1_700_000_000 + i, 1_700_000_000 + i))
    return src


def test_rejected_records_do_not_move_the_watermark(spark, tmp_dir):
    src = _three_files(tmp_dir, ("2999-01-01T00:00:00", '"abc"'))
    v = streams.clean_stream(streams.read_lines_stream(spark, src, max_files_per_trigger=1))
    q = streams.start_to_table(streams.dedup_stream(v, "1 hour"), os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(tmp_dir, "o")).count() == 6


def test_readings_ahead_of_arrival_are_reported(spark, tmp_dir):
    src = _three_files(tmp_dir, ("2999-01-01T00:00:00", "100"))
    v = streams.clean_stream(streams.read_lines_stream(spark, src, max_files_per_trigger=1), max_ahead="1 day")
    q = streams.start_to_table(streams.dedup_stream(v, "1 hour"), os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(tmp_dir, "o")).count() == 6
    batch = streams.clean_stream(spark.read.text(src).select("value", F.lit(0).cast("long").alias("_ord")), max_ahead="1 day")
    assert [r[0] for r in batch.where("_status IS NOT NULL").select("_status").collect()] == [streams.AHEAD_OF_ARRIVAL]


def test_a_poisoned_batch_is_held_back(spark, tmp_dir):
    import datetime as dt
    base = os.path.join(tmp_dir, "m")
    r = streams.MartRefresher(spark, base, fixtures.dim_engines(spark), fixtures.dim_metrics(spark), dt.datetime(2025, 2, 1), gate=True)
    r(_batch(spark, [1]).dropDuplicates(["timestamp", "engine_id"]), 0)
    first = r.fact().count()
    r(_batch(spark, [1, 2]).dropDuplicates(["timestamp", "engine_id"]), 1)     # day 1 was committed before
    assert r.committed()[0] == 0 and r.fact().count() == first
    held = r.held().groupBy("test_name", "batch").count().collect()
    assert [(x.test_name, x.batch) for x in held] == [("grain:fact:airbyte_raw_id", 1)]
    assert 0 < held[0]["count"] == r.held().select("airbyte_raw_id").distinct().count() <= first
    good = _batch(spark, [2]).dropDuplicates(["timestamp", "engine_id"])
    r(good, 2)
    assert r.committed()[0] == 2 and r.fact().count() == first + good.count()
    keys = [x[0] for x in r.fact().select("reading_key").orderBy("reading_key").collect()]
    assert keys == list(range(1, len(keys) + 1))
    assert not os.path.exists(os.path.join(base, "work"))
