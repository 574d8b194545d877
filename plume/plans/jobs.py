"""The end-to-end batch job: landing folder of JSON Lines -> tables and test results.

    python -m plume.plans.jobs --input <landing> --output <base> --engines <table> --metrics <table> [--as-of ISO]
    spark-submit --py-files plume.zip plume/plans/jobs.py --input <landing> --output <base> --engines ... --metrics ...

``--engines`` and ``--metrics`` are parquet folders with the columns of ``schemas.DIM_ENGINES_SCHEMA`` and
``schemas.DIM_METRICS_SCHEMA``; absent or NULL engine attributes take their declared defaults, and keys that
would fan readings out stop the job before it reads a line.

Steps (each a Spark job over the whole input; lineage is cut by the tables it
writes under ``--output``):

1. read and parse the JSON Lines once (``ingest/``: valid, dropped and broken lines, logged events),
   clean and deduplicate them, store the raw table and export it as clean CSV; the run statistics
   are counted from the parsed rows and checked against the table;
2. stage the raw table, build the keyed fact table;
3. store fact and marts as analysed tables (A6-A8);
4. run the 45 declared tests on the stored models; keep the failing rows of the
   tests that fail.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession

from plume.operators import ingest, quality
from plume.operators.dims import checked_engines, checked_metrics
from plume.operators.fact import fact_unkeyed, with_reading_key
from plume.operators.materialize import materialize_models
from plume.operators.staging import staging
from plume.session import remove
from plume.sources.csv import publish_clean_csv
from plume.sources.raw import raw_load
from plume.sources.text import read_jsonl


def run_batch(spark: SparkSession, input_path: str, output: str, engines: DataFrame, metrics: DataFrame, as_of=None,
              table_prefix: str = "telemetry", keep_work: bool = False) -> dict:
    output = output.rstrip("/")
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    engines, metrics = checked_engines(engines), checked_metrics(metrics)

    parsed = ingest.land_outputs(read_jsonl(spark, input_path), f"{output}/ingest")
    raw_path = f"{output}/raw"
    raw_load(parsed.clean(), as_of).write.mode("overwrite").parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    publish_clean_csv(raw, f"{output}/clean_csv")
    # counted in an aggregate of its own: counters that ride along a write may count a rerun task twice
    summary = parsed.summary().first().asDict()
    if summary["unique_records"] != raw.count():
        raise RuntimeError(f"the raw table does not hold the {summary['unique_records']} records that were counted")
    stg = staging(raw, as_of)
    fact = with_reading_key(fact_unkeyed(stg, engines, metrics), workdir=f"{output}/work")
    stored = materialize_models(spark, fact, as_of, f"{output}/tables", table_prefix)
    if not keep_work:
        remove(spark, f"{output}/work")         # the keyed rows now live in the fact table
    stored_fact = stored["fact"].drop("reading_date")
    models = {"raw": raw, "staging": stg, "fact": stored_fact,
              "engine_summary": stored["engine_summary"], "daily_trends": stored["daily_trends"]}
    tests = quality.run_declared_tests(models)
    tests.write.mode("overwrite").parquet(f"{output}/test_results")
    failed = [r["test_name"] for r in spark.read.parquet(f"{output}/test_results").where("status = 'fail'")
              .select("test_name").collect()]          # at most 45 names
    # keep the failing rows of the tests that failed (one more scan per failed test only)
    quality.store_test_failures(models, f"{output}/test_failures",
                                [t for t in quality.DECLARED_TESTS if t.name in set(failed)])
    return {"summary": {k: (str(v) if v is not None and not isinstance(v, int) else v)
                        for k, v in summary.items()},
            "failed_tests": failed}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Clean telemetry JSON Lines and build the models")
    ap.add_argument("--input", required=True, help="folder (or file) of JSON Lines")
    ap.add_argument("--output", required=True, help="base folder for the CSV, tables and test results")
    ap.add_argument("--engines", required=True, help="engine dimension (parquet)")
    ap.add_argument("--metrics", required=True, help="metric dimension (parquet)")
    ap.add_argument("--as-of", default=None, help="processing time (ISO), default: now")
    args = ap.parse_args(argv)
    from plume.session import get_spark
    spark = get_spark("plume-batch")
    as_of = _dt.datetime.fromisoformat(args.as_of) if args.as_of else None
    engines, metrics = spark.read.parquet(args.engines), spark.read.parquet(args.metrics)
    print(json.dumps(run_batch(spark, args.input, args.output, engines, metrics, as_of)))


if __name__ == "__main__":
    main()
