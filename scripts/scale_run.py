"""Scale smoke run: millions of generated readings with a hot spot, end to end.

Usage: python scripts/scale_run.py <n_readings> <work_dir>

The first third of the readings is squeezed into one hour of one engine (a hot
(time_key, engine_key) group for the reading key), and 5% of the lines are extra
copies of a single reading (a hot dedup key). Prints one JSON line with stage
timings, row counts and the balance of the reading-key partitions.
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
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    work = sys.argv[2]
    from plume.session import get_spark
    spark = get_spark("plume-scale", master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", shuffle_partitions=64,
                      extra={"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    from plume.functions.columns import ntz_literal
    from tests.tools import generator

    t = {}
    t0 = time.perf_counter()
    start = dt.datetime(2025, 1, 1)
    r = generator.generate_readings(spark.range(n).repartition(64), seed=1, start=start)
    hot = F.col("id") < n // 3
    r = (r.withColumn("timestamp", F.when(hot, F.timestamp_add("MICROSECOND", F.col("id"),
                                                                ntz_literal(start)))
                      .otherwise(F.col("timestamp")))
          .withColumn("engine_id", F.when(hot, F.lit("TRE-001")).otherwise(F.col("engine_id"))))
    copies = (spark.range(n // 20).select((F.lit(1 << 41).cast("long") + F.col("id")).alias("_ord"))
              .select(F.lit('{"timestamp": "2025-06-01T00:00:00", "engine_id": "TRE-002", '
                            '"chamber_pressure": 200, "fuel_flow": 100, "temperature": 3000}').alias("value"), "_ord"))
    lines = generator.to_jsonl(r).unionByName(copies)
    landing = f"{work}/landing"
    lines.orderBy("_ord").select("value").write.mode("overwrite").text(landing)
    t["generate_and_land"] = time.perf_counter() - t0

    from plume.plans.jobs import run_batch
    from plume.sources import fixtures
    t0 = time.perf_counter()
    res = run_batch(spark, landing, f"{work}/out", fixtures.dim_engines(spark), fixtures.dim_metrics(spark),
                    as_of=dt.datetime(2025, 2, 1), table_prefix="scale", keep_work=True)
    t["run_batch"] = time.perf_counter() - t0

    # reading-key balance: rows per range partition of the F9 key table (the upper
    # bits of the tag are the partition index)
    import glob
    tagged = spark.read.parquet(glob.glob(f"{work}/out/work/plume-rownum-*")[0])
    parts = tagged.groupBy(F.shiftright("_tag", 33).alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.min("time_key").alias("t0"))
    stats = parts.agg(F.count("*").alias("parts"), F.min("n").alias("min"), F.max("n").alias("max"),
                      F.avg("n").alias("avg")).collect()[0]
    hot_parts = parts.where(F.col("t0") == int(start.strftime("%Y%m%d%H"))).count()
    fact = spark.read.parquet(f"{work}/out/tables/fact")
    keys = fact.agg(F.min("reading_key"), F.max("reading_key"), F.count("*")).collect()[0]
    print(json.dumps({
        "readings": n, "hot_key_copies": n // 20,
        "seconds": {k: round(v, 1) for k, v in t.items()},
        "readings_per_sec": round(n / t["run_batch"]),
        "summary": res["summary"], "failed_tests": res["failed_tests"],
        "fact_rows": keys[2], "reading_key_range": [keys[0], keys[1]],
        "key_partitions": stats["parts"], "rows_per_key_partition": [stats["min"], round(stats["avg"]), stats["max"]],
        "key_partitions_holding_the_hot_hour": hot_parts,
    }))


if __name__ == "__main__":
    main()
