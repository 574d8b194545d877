"""Streaming marts (K4) at scale: generated readings in many files, several micro-batches.

Usage: python scripts/stream_scale_run.py <n_readings> <work_dir>
Prints micro-batch timings and whether the streamed daily mart equals the batch one.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
    work = sys.argv[2]
    from plume.session import get_spark
    spark = get_spark("plume-stream-scale", master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
                      shuffle_partitions=16, extra={"spark.driver.memory": "8g",
                                                    "spark.ui.showConsoleProgress": "false"})
    from plume.operators import ingest, marts
    from plume.operators.fact import fact_unkeyed
    from plume.operators.staging import staging
    from plume.sources import fixtures
    from plume.sources.raw import raw_load
    from plume.sources.text import read_jsonl
    from plume.streaming import streams
    from tests.tools import generator

    lines = generator.generate_jsonl(spark, n, seed=3)
    landing = f"{work}/landing"
    # ten files in time order, written one after another (arrival order)
    for i in range(10):
        lo, hi = i * n // 10, (i + 1) * n // 10
        part = lines.where((F.col("_ord") >= lo) & (F.col("_ord") < hi))
        if i == 9:
            part = part.unionByName(lines.where(F.col("_ord") >= (1 << 40)))     # late copies last
        part.orderBy("_ord").coalesce(1).select("value").write.mode("overwrite").text(f"{landing}/f{i:02d}")

    as_of = dt.datetime(2025, 2, 1)
    engines, metrics = fixtures.dim_engines(spark), fixtures.dim_metrics(spark)
    refresher = streams.MartRefresher(spark, f"{work}/tables", engines, metrics, as_of=as_of)
    src = (spark.readStream.format("text").option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", 2).load(landing).select("value", F.lit(0).cast("long").alias("_ord")))
    deduped = streams.dedup_stream(streams.clean_stream(src), "3650 days")
    t0 = time.perf_counter()
    q = (deduped.writeStream.foreachBatch(refresher).option("checkpointLocation", f"{work}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    elapsed = time.perf_counter() - t0
    batches = [round(p["durationMs"].get("triggerExecution", 0) / 1000, 1) for p in q.recentProgress
               if p.get("numInputRows", 0) > 0]

    streamed = refresher.read("daily_trends")
    clean = ingest.clean_lines(read_jsonl(spark, [f"{landing}/f{i:02d}" for i in range(10)]))
    batch = marts.daily_trends(fact_unkeyed(staging(raw_load(clean, as_of), as_of), engines, metrics), as_of)
    cols = ["date_actual", "total_readings", "total_anomalies", "daily_anomaly_rate_percent",
            "avg_daily_performance_score", "critical_readings", "alert_flag", "anomaly_trend", "performance_trend"]
    a = sorted(map(tuple, streamed.select(cols).collect()))
    b = sorted(map(tuple, batch.select(cols).collect()))
    print(json.dumps({"readings": n, "stream_seconds": round(elapsed, 1), "micro_batch_seconds": batches,
                      "days": len(b), "streamed_equals_batch": a == b}))


if __name__ == "__main__":
    main()
