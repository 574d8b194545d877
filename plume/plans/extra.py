"""Registered queries that run writes or streams: streaming, materialisation.

Each one reads ``events`` and writes only under the shared folder
(``spark.checkpoint.dir``). All have DuckDB oracles.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plume import rules
from plume.operators import marts, quality
from plume.operators.materialize import materialize_models
from plume.plans.pipeline import Pipeline
from plume.session import shared_dir
from plume.sources import fixtures
from plume.sources.generations import RawTable
from plume.sources.raw import raw_load
from plume.streaming import streams
from plume.streaming.ledger import DUPLICATE, LATE, ON_TIME, ReadingLedger

# event time spanned by the driver's events (30 days) fits inside this watermark
STREAM_WATERMARK = "40 days"
_MEASURES = ("chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit")


def _work(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/plume-{what}-{uuid.uuid4().hex}"


def _land(spark: SparkSession, sf_dir: str, base: str) -> tuple[str, int]:
    """Write the dirty lines of ``events`` as text files, originals then duplicates.

    Two writes, so the duplicate copies arrive after the originals (a later file
    modification time). Returns the landing folder and the number of files of
    the first write: with that many files per trigger, the originals form the
    first micro-batch and the late copies the next ones.
    """
    events = Pipeline(spark, sf_dir).events
    landing = f"{base}/landing"
    # the events are sorted, not the text, which would be made twice for it; the copies are few or short
    first = fixtures.jsonl_from_events(events.orderBy("event_id")).where("part = 0")
    copies = fixtures.jsonl_from_events(events).where("part > 0").orderBy("part", "event_id")
    for folder, rows in (("a", first), ("b", copies)):
        rows.select("value").write.mode("overwrite").text(f"{landing}/{folder}")
    return landing, _count_files(spark, f"{landing}/a")


def _count_files(spark: SparkSession, path: str) -> int:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(1 for st in fs.listStatus(p) if st.isFile() and not st.getPath().getName().startswith(("_", ".")))


def _run_stream(spark, sf_dir, build, mode="append", split_batches=False) -> DataFrame:
    base = _work(spark, "stream")
    landing, n_first = _land(spark, sf_dir, base)
    src = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if split_batches:
        src = src.option("maxFilesPerTrigger", max(n_first, 1))
    lines = src.load(landing).select("value", F.lit(0).cast("long").alias("_ord"))
    out = build(lines)
    q = streams.start_to_table(out, f"{base}/sink", f"{base}/checkpoint", mode=mode)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink")


def _measures_double(df: DataFrame) -> DataFrame:
    for c in rules.MEASURE_FIELDS:
        df = df.withColumn(c, F.trim(c).cast("double"))
    return df


def q_stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: streaming parse + validate + correct (no dedup)."""
    return _measures_double(_run_stream(
        spark, sf_dir, lambda lines: streams.valid_stream(streams.clean_stream(lines))))


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: streaming dedup within the watermark."""
    return _measures_double(_run_stream(
        spark, sf_dir,
        lambda lines: streams.dedup_stream(streams.clean_stream(lines), STREAM_WATERMARK).drop("_event_time"),
        split_batches=True))


def q_stream_hourly_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: hourly anomaly windows; windows still open at the end are not emitted (append mode)."""
    return _run_stream(
        spark, sf_dir,
        lambda lines: streams.hourly_anomalies_stream(
            streams.dedup_stream(streams.clean_stream(lines), "2 hours")),
        split_batches=True)


def q_stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K3: what became of the stream's valid readings, late ones with their lateness."""
    base = _work(spark, "ledger")
    landing, n_first = _land(spark, sf_dir, base)
    ledger = ReadingLedger(spark, f"{base}/ledger", "2 hours")
    lines = (spark.readStream.format("text").option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max(n_first, 1)).load(landing)
             .select("value", F.lit(0).cast("long").alias("_ord")))
    q = (streams.clean_stream(lines).writeStream.foreachBatch(ledger)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    on_time, repeated, late = (ledger.rows(x).select("timestamp", "engine_id", F.lit(x).alias("outcome"), "copies", "lateness_us")
                               for x in (ON_TIME, DUPLICATE, LATE))
    removed = on_time.unionByName(repeated).where("copies > 0").withColumn("outcome", F.lit(DUPLICATE))
    one = F.lit(1).cast("bigint")
    return (on_time.withColumn("copies", one).unionByName(removed).unionByName(late.withColumn("copies", one))
            .groupBy("timestamp", "engine_id", "outcome")
            .agg(F.sum("copies").alias("readings"), F.max("lateness_us").alias("lateness_us")))


def q_raw_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the raw table after two full refreshes, a partial delivery and a stale one."""
    p = Pipeline(spark, sf_dir)
    table = RawTable(spark, _work(spark, "raw"))
    clean = p.outputs.clean()

    def delivery(generation: int, rows: DataFrame) -> DataFrame:
        return raw_load(rows, p.as_of + _dt.timedelta(days=generation - 1), generation)

    table.load(delivery(1, clean), full=True)
    table.load(delivery(2, clean.where("NOT engine_id <=> 'TRE-004'")), full=True)
    table.load(delivery(3, clean.where("engine_id = 'TRE-002'").withColumn("temperature", F.lit("3500"))))
    table.load(delivery(1, clean.where("engine_id IN ('TRE-003', 'TRE-004')").withColumn("temperature", F.lit("1"))))
    return _measures_double(table.rows())


def _refreshed(spark: SparkSession, sf_dir: str) -> streams.MartRefresher:
    base = _work(spark, "marts")
    landing, n_first = _land(spark, sf_dir, base)
    p = Pipeline(spark, sf_dir)
    refresher = streams.MartRefresher(spark, f"{base}/tables", p.engines, p.metrics, as_of=p.as_of)
    lines = (spark.readStream.format("text").option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max(n_first, 1)).load(landing)
             .select("value", F.lit(0).cast("long").alias("_ord")))
    deduped = streams.dedup_stream(streams.clean_stream(lines), STREAM_WATERMARK)
    q = (deduped.writeStream.foreachBatch(refresher)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return refresher


def q_stream_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: daily mart kept current by ``foreachBatch``."""
    return _refreshed(spark, sf_dir).read("daily_trends")


def q_stream_engine_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: engine mart kept current by ``foreachBatch``, with all columns of the batch mart."""
    return _refreshed(spark, sf_dir).read("engine_summary")


def q_stream_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact that the stream has committed, keys 1..N."""
    return _refreshed(spark, sf_dir).fact().select(
        "reading_key", "engine_key", "time_key", "airbyte_raw_id", "reading_timestamp", "engine_id", *_MEASURES,
        "performance_score", "is_anomaly", "anomaly_type", "health_status")


def q_stream_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J over K4: the declared tests of the fact and both marts, on the streamed tables."""
    r = _refreshed(spark, sf_dir)
    return quality.run_declared_tests({"fact": r.fact(), "engine_summary": r.read("engine_summary"),
                                       "daily_trends": r.read("daily_trends")})


def q_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store fact and marts as analysed tables; rows per stored table, by its contents, by
    its statistics, and (fact) as far as its files keep the layout."""
    p = Pipeline(spark, sf_dir)
    base = _work(spark, "tables")
    prefix = "plume_" + uuid.uuid4().hex[:8]
    stored_fact = materialize_models(spark, p.fact(), p.as_of, base, prefix)["fact"]
    es = marts.engine_summary(stored_fact.drop("reading_date"), p.as_of)
    known = spark.sql(f"DESCRIBE EXTENDED {prefix}_fact").where("col_name = 'Statistics'")
    analysed = known.select(F.lit("fact_statistics").alias("table_name"),
                            F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"))
    # rows in the folder of their own date, and not below an earlier row of their file
    by_file = Window.partitionBy(F.input_file_name()).orderBy("reading_key")
    kept = (stored_fact.withColumn("before", F.lag("time_key").over(by_file))
            .where("reading_date = to_date(reading_timestamp) AND (before IS NULL OR before <= time_key)")
            .agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("fact_layout").alias("table_name"), "row_count"))
    counts = [spark.table(f"{prefix}_{t}").agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(t).alias("table_name"), "row_count")
              for t in ("fact", "engine_summary", "daily_trends")]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    out = out.unionByName(analysed).unionByName(kept)
    return out.unionByName(es.agg(F.count(F.lit(1)).alias("row_count"))
                           .select(F.lit("engine_summary_from_stored_fact").alias("table_name"), "row_count"))


def queries() -> dict:
    return {
        "stream_clean": q_stream_clean,
        "stream_dedup": q_stream_dedup,
        "stream_ledger": q_stream_ledger,
        "raw_generations": q_raw_generations,
        "stream_hourly_anomalies": q_stream_hourly_anomalies,
        "stream_marts": q_stream_marts,
        "stream_engine_mart": q_stream_engine_mart,
        "stream_fact": q_stream_fact,
        "stream_dq": q_stream_dq,
        "materialize": q_materialize,
    }
