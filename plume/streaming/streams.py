"""K1-K4: the cleaner and the marts on Structured Streaming.

* K1 ``clean_stream`` — JSON Lines files arriving in a folder, parsed and
  validated by the same stateless functions as the batch path.
* K2 ``dedup_stream`` — first copy per ``(timestamp, engine_id)`` kept, state
  bounded by an event-time watermark (``dropDuplicatesWithinWatermark``) instead
  of the batch cleaner's unbounded seen-set. Only valid records move the watermark.
* K3 ``hourly_anomalies_stream`` — tumbling one-hour windows; a window is
  emitted once the watermark passes its end, later readings are dropped.
* K4 ``MartRefresher`` — ``foreachBatch``: each micro-batch is appended to a
  date-partitioned fact table, its per-(engine, date) partial aggregates are merged
  with the last committed ones, and the two marts are rebuilt from the partials —
  small tables, whatever the fact size.

Every query checkpoints under the shared folder, so a restarted job resumes
where it stopped.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plume import rules
from plume.functions.columns import (day_of_week_sun0, engine_health, exact_avg, iso_timestamp_text, ntz_literal,
                                     pct_half_up, to_double, wide_sum)
from plume.operators import ingest, marts, quality, serving
from plume.operators.fact import fact_unkeyed, with_reading_key
from plume.operators.keys import written
from plume.operators.staging import staging
from plume.operators.versions import Committed
from plume.session import remove
from plume.sources.raw import raw_load

DEFAULT_WATERMARK = "1 hour"


def read_lines_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir).select("value", F.lit(0).cast("long").alias("_ord"))


#: Status of a valid record that runs further ahead of its arrival than a stream allows.
AHEAD_OF_ARRIVAL = "ahead_of_arrival"


def clean_stream(lines: DataFrame, max_ahead: str | None = None) -> DataFrame:
    """K1: validated records of a line stream (all records, ``_status`` NULL = valid).

    ``_event_time`` is set for valid records alone: what is rejected must not move a
    watermark. One valid reading with a clock far in the future would still move it past
    all others, so ``max_ahead`` (an interval such as ``"1 day"``) rejects readings further
    ahead of the batch's processing time, with the status ``ahead_of_arrival``.
    """
    v = ingest.validate(ingest.records_from_lines(ingest.classify_lines(lines)))
    time = iso_timestamp_text(F.col("timestamp"))
    if max_ahead:
        late = time > F.current_timestamp().cast("timestamp_ntz") + F.expr(f"INTERVAL {max_ahead}")
        v = v.withColumn("_status", F.when(F.col("_status").isNull() & late, AHEAD_OF_ARRIVAL).otherwise(F.col("_status")))
    return v.withColumn("_event_time", F.when(F.col("_status").isNull(), time))


def observe_counts(validated: DataFrame, name: str = "plume_ingest") -> DataFrame:
    """C13 on a stream: per-micro-batch counters without an extra pass.

    They are reported in ``query.lastProgress["observedMetrics"][name]``
    (``total_records``, ``parsing_errors``, ``valid_records``, ``corrected_records``).
    """
    valid = F.col("_status").isNull()
    return validated.observe(
        name,
        F.count_if(F.col("_kind") == ingest.RECORD).alias("total_records"),
        F.count_if(F.col("_kind") == ingest.PARSE_ERROR).alias("parsing_errors"),
        F.count_if(valid).alias("valid_records"),
        F.count_if(valid & F.col("_corrected")).alias("corrected_records"))


def valid_stream(validated: DataFrame) -> DataFrame:
    """The valid records of a validated stream, as CSV columns (parse stays single,
    see ``ingest.emit_rows``)."""
    return ingest.emit_rows(validated, F.col("_status").isNull(), *rules.CSV_COLUMNS)


def dedup_stream(validated: DataFrame, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """K2: drop later copies of a ``(timestamp, engine_id)`` seen within the watermark.

    Validity is part of the key, so an invalid copy never hides a valid one, and
    the validity filter sits *above* the stateful operator (it is not pushed
    below it, where it would re-run the parsing). Invalid records get the epoch as
    event time: they never move the watermark and fall behind it at once.
    """
    keyed = (validated
             .withColumn("_valid", F.col("_status").isNull())
             # watermarks need TIMESTAMP: the wall clock is read in the session time zone
             .withColumn("_event_time", F.coalesce("_event_time", ntz_literal("1970-01-01 00:00:00"))
                         .cast("timestamp"))
             .withWatermark("_event_time", watermark)
             .dropDuplicatesWithinWatermark(["timestamp", "engine_id", "_valid"]))
    return keyed.where("_valid").select(*rules.CSV_COLUMNS, "_event_time")


def hourly_anomalies_stream(deduped: DataFrame) -> DataFrame:
    """K3: anomaly count and total per one-hour event-time window (append mode).

    The readings go through the batch staging unchanged; the watermarked event
    time is carried along and drives the tumbling window.
    """
    stg = staging(raw_load(deduped, F.current_timestamp(), passthrough=("_event_time",)),
                  passthrough=("_event_time",))
    start = _hour_start_offset(deduped.sparkSession)
    agg = (stg.groupBy(F.window("_event_time", "1 hour", startTime=start).alias("w"))
           .agg(F.count_if("is_anomaly").cast("bigint").alias("anomaly_count"),
                F.count(F.lit(1)).cast("bigint").alias("total_readings")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                      "anomaly_count", "total_readings")


def _hour_start_offset(spark: SparkSession) -> str:
    """``startTime`` that puts hourly windows on wall-clock hours of the session zone.

    Windows are aligned to UTC; a zone whose offset is not a whole hour (+05:30,
    +05:45, ...) needs the windows shifted by the sub-hour part of its offset.
    """
    from zoneinfo import ZoneInfo

    tz = spark.conf.get("spark.sql.session.timeZone")
    try:
        offset = ZoneInfo(tz).utcoffset(_dt.datetime(2024, 1, 1))
    except Exception:  # noqa: BLE001 - offsets like "+05:30" or unknown names: no shift
        return "0 minutes"
    minutes = int((-offset.total_seconds() // 60) % 60)
    return f"{minutes} minutes"


def start_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                   available_now: bool = True, fmt: str = "parquet"):
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    w = w.outputMode(mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


# ---------------------------------------------------------------------------- K4

class MartRefresher(Committed):
    """``foreachBatch`` sink keeping the fact table and both marts current.

    Under ``base``: ``fact/`` (parquet, partitioned by ``reading_date``; files are only ever
    added), ``versions/<batch>-<attempt>/`` with the partials, both marts and the list of
    committed attempts, and ``commits/<batch>``, a file that names the attempt. A version is
    complete before its commit file appears (by rename); readers and the next batch take the
    newest commit (``read``: ``engine_summary``, ``daily_trends``, ``partials``). So an attempt that dies anywhere leaves the last version in place, its fact
    rows belong to no committed attempt and are not read, and the retry starts from the same
    state. Older versions are removed. A batch costs work in proportion to itself and to the
    partials (one row per engine and date), not to the history.

    ``reading_key`` is dense inside a batch and goes on from the last key that the newest commit
    names, so the keys of committed batches are 1..N, whatever attempts died in between.

    With ``gate``, a batch whose rows break a declared test of the fact, or repeat a raw id of the
    batch or of committed rows, is held back: its failing rows go to ``held/<batch>`` with the test
    that each one breaks, nothing of it is committed, and the next batch goes on from the last
    version. A raw id's copies share their reading's date, so only the batch's own dates are read.
    """

    def __init__(self, spark: SparkSession, base: str, engines: DataFrame, metrics: DataFrame, as_of=None,
                 gate: bool = False):
        super().__init__(spark, base)
        self.gate = gate
        self.engines = engines
        self.metrics = metrics
        self.as_of = as_of          # processing time; None = the time each batch runs

    @property
    def fact_path(self):
        return f"{self.base}/fact"

    def fact(self) -> DataFrame:
        """Fact rows of committed attempts (one small row per batch says which)."""
        return self._committed_rows().drop("_batch", "_attempt")

    def _committed_rows(self) -> DataFrame:
        return (self.spark.read.parquet(self.fact_path)
                .join(self.read("attempts").select("_batch", "_attempt"), ["_batch", "_attempt"], "left_semi"))

    def held(self) -> DataFrame:
        """Failing rows of the batches that the gate held back: test, batch and the fact's columns."""
        return self.spark.read.parquet(f"{self.base}/held/*")

    def _held(self, mine: DataFrame, earlier: bool, batch_id: int) -> bool:
        again = mine.groupBy("airbyte_raw_id").count().where("count > 1").select("airbyte_raw_id")
        if earlier:
            key = ["reading_date", "airbyte_raw_id"]
            again = again.unionByName(mine.select(*key).join(self._committed_rows().select(*key), key, "left_semi")
                                      .select("airbyte_raw_id"))
        failing = quality.row_failures(mine, "fact").unionByName(
            mine.join(again.distinct(), "airbyte_raw_id", "left_semi").withColumn("test_name", F.lit("grain:fact:airbyte_raw_id")))
        path = f"{self.base}/held/{batch_id}"
        failing.withColumnRenamed("_batch", "batch").drop("_attempt").write.mode("overwrite").parquet(path)
        if self.spark.read.parquet(path).isEmpty():
            remove(self.spark, path)
            return False
        return True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        state = self.committed()
        if state and batch_id <= state[0]:
            return                              # committed before the stream could say so
        now = self.as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        attempt = uuid.uuid4().hex
        work = f"{self.base}/work/{batch_id}-{attempt}"
        raw = raw_load(batch.select(*rules.CSV_COLUMNS), now)
        last = (self.spark.read.parquet(f"{state[1]}/attempts").agg(F.max("_last_key")).first()[0] if state else 0)
        # parsed, deduplicated and staged once: the range partitioning of the key reads its rows twice
        unkeyed = written(fact_unkeyed(staging(raw, now), self.engines, self.metrics), "batch", work)
        fact = with_reading_key(unkeyed, workdir=work)
        self._append(fact.withColumn("reading_key", F.col("reading_key") + F.lit(last)), batch_id, attempt)
        mine = (self.spark.read.parquet(self.fact_path)
                .where((F.col("_batch") == batch_id) & (F.col("_attempt") == attempt)))
        if self.gate and self._held(mine, state is not None, batch_id):
            self._prune()
            return
        merged = partials(mine)
        attempts = self.spark.createDataFrame([(batch_id, attempt, last + mine.count())],
                                              "_batch long, _attempt string, _last_key long")
        if state:
            merged = merge_partials(merged.unionByName(self.spark.read.parquet(f"{state[1]}/partials")))
            attempts = attempts.unionByName(self.spark.read.parquet(f"{state[1]}/attempts"))
        version = f"{self.base}/versions/{batch_id}-{attempt}"
        merged.write.parquet(f"{version}/partials")
        attempts.coalesce(1).write.parquet(f"{version}/attempts")
        p = self.spark.read.parquet(f"{version}/partials")
        engine_summary_from_partials(p, now, work).write.parquet(f"{version}/engine_summary")
        daily_trends_from_partials(p, now).write.parquet(f"{version}/daily_trends")
        self._commit(batch_id, attempt)
        self._prune()

    def _append(self, fact: DataFrame, batch_id: int, attempt: str) -> None:
        (fact.withColumn("reading_date", F.to_date("reading_timestamp"))
         .withColumn("_batch", F.lit(batch_id).cast("long")).withColumn("_attempt", F.lit(attempt))
         .write.mode("append").partitionBy("reading_date").parquet(self.fact_path))


def merge_partials(p: DataFrame) -> DataFrame:
    """One row per (engine, date) from several partials of it: sums add up, extremes and times
    extend, and means and squared deviations combine pairwise (see ``_merged_stddev``)."""
    keys = ["engine_id", "date_actual"]
    tags = ["p", "f", "t", "score"]
    w = Window.partitionBy(*keys)
    total = F.sum("n").over(w)
    means = {t: F.sum(F.col("n") * F.col(f"mean_{t}")).over(w) / total for t in tags}
    p = p.select("*", *[means[t].alias(f"_all_{t}") for t in tags])
    p = p.select("*", *[(F.col(f"m2_{t}") + F.col("n") * F.pow(F.col(f"mean_{t}") - F.col(f"_all_{t}"), 2)).alias(f"_dev_{t}")
                        for t in tags])
    plain = [c for c in p.columns if c not in keys and not c.startswith("_")]
    aggs = []
    for c in plain:
        if c.startswith("mean_"):
            aggs.append(F.first(f"_all_{c[5:]}").alias(c))
        elif c.startswith("m2_"):
            aggs.append(F.sum(f"_dev_{c[3:]}").alias(c))
        elif c.startswith(("min_", "first_")):
            aggs.append(F.min(c).alias(c))
        elif c.startswith(("max_", "last_")):
            aggs.append(F.max(c).alias(c))
        elif c.startswith("sum_") and c != "sum_eff":
            aggs.append(wide_sum(c, 1 if c == "sum_score" else 3).alias(c))
        else:
            aggs.append(F.sum(c).alias(c))
    return p.groupBy(*keys).agg(*aggs)


def _moments(col: str, tag: str):
    """Mean and M2 (sum of squared deviations) of one partial, both computed stably."""
    x = to_double(col)
    return [F.avg(x).alias(f"mean_{tag}"), (F.var_pop(x) * F.count(x)).alias(f"m2_{tag}")]


def _merged_stddev(p: DataFrame, group: str, tag: str) -> DataFrame:
    """Sample stddev of the union of partials (Chan et al. pairwise combination):
    M2 = sum(M2_i) + sum(n_i * (mean_i - mean)^2), var = M2 / (N - 1)."""
    w = Window.partitionBy(group)
    mean_all = F.sum(F.col("n") * F.col(f"mean_{tag}")).over(w) / F.sum("n").over(w)
    return p.withColumn(f"_dev_{tag}", F.col(f"m2_{tag}")
                        + F.col("n") * F.pow(F.col(f"mean_{tag}") - mean_all, 2))


def partials(fact: DataFrame) -> DataFrame:
    """Mergeable per-(engine, date) aggregates of the fact table."""
    p, f, t = "chamber_pressure_psi", "fuel_flow_kg_per_sec", "temperature_fahrenheit"
    hs, at = F.col("health_status"), F.col("anomaly_type")
    return fact.groupBy("engine_id", F.to_date("reading_timestamp").alias("date_actual")).agg(
        F.count(F.lit(1)).alias("n"),
        wide_sum(p).alias("sum_p"), wide_sum(f).alias("sum_f"), wide_sum(t).alias("sum_t"),
        *_moments(p, "p"), *_moments(f, "f"), *_moments(t, "t"),
        F.sum("fuel_efficiency_ratio").alias("sum_eff"), F.count("fuel_efficiency_ratio").alias("n_eff"),
        wide_sum("performance_score", 1).alias("sum_score"),
        *_moments("performance_score", "score"),
        F.min(p).alias("min_p"), F.max(p).alias("max_p"), F.min(f).alias("min_f"), F.max(f).alias("max_f"),
        F.min(t).alias("min_t"), F.max(t).alias("max_t"),
        F.min("performance_score").alias("min_score"), F.max("performance_score").alias("max_score"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(at.like("%PRESSURE%")).alias("pressure_anomalies"),
        F.count_if(at.like("%FUEL%")).alias("fuel_anomalies"),
        F.count_if(at.like("%TEMPERATURE%")).alias("temperature_anomalies"),
        *[F.count_if(at == a).alias(a.lower() + "_anomalies") for a in rules.ANOMALY_TYPES],
        *[F.count_if(hs == h).alias(h.lower() + "_readings") for h in rules.READING_HEALTH_VALUES],
        F.count("airbyte_raw_id").alias("with_id"),
        F.min("created_at").alias("first_created"), F.max("created_at").alias("last_created"),
        F.max("reading_timestamp").alias("last_reading"),
    )


def _stddev(n: str, dev: str):
    """Sample stddev from a total count and a merged M2; NULL for one row."""
    n, dev = F.col(n), F.col(dev)
    return F.when(n > 1, F.sqrt(F.greatest(dev / (n - 1), F.lit(0.0))))


def engine_summary_from_partials(p: DataFrame, as_of=None, workdir: str | None = None) -> DataFrame:
    """The engine mart rebuilt from partials (no pass over the fact table)."""
    for tag in ("p", "f", "t"):
        p = _merged_stddev(p, "engine_id", tag)
    g = p.groupBy("engine_id").agg(
        *[F.sum(c).alias(c) for c in ("n", "sum_p", "sum_f", "sum_t", "_dev_p", "_dev_f", "_dev_t", "sum_eff",
                                      "n_eff", "sum_score", "anomalies", "pressure_anomalies",
                                      "fuel_anomalies", "temperature_anomalies", "with_id")],
        *[F.min(c).alias(c) for c in ("min_p", "min_f", "min_t", "first_created")],
        *[F.max(c).alias(c) for c in ("max_p", "max_f", "max_t", "last_created")],
        F.min("date_actual").alias("earliest_reading_date"), F.max("date_actual").alias("latest_reading_date"))
    n = F.col("n")
    rows = marts.engine_rows(g.select(
        "engine_id", n.alias("total_readings"),
        *[F.col(f"sum_{x}").alias(f"_sum_{y}") for x, y in (("p", "p"), ("f", "f"), ("t", "t"), ("score", "s"))],
        *[n.alias(f"_n_{x}") for x in ("p", "f", "t", "s")],      # no measure of a fact row is NULL
        (F.col("sum_eff") / F.col("n_eff")).alias("avg_fuel_efficiency_ratio"),
        _stddev("n", "_dev_p").alias("stddev_chamber_pressure"),
        _stddev("n", "_dev_f").alias("stddev_fuel_flow"),
        _stddev("n", "_dev_t").alias("stddev_temperature"),
        F.col("min_p").alias("min_chamber_pressure_psi"), F.col("max_p").alias("max_chamber_pressure_psi"),
        F.col("min_f").alias("min_fuel_flow_kg_per_sec"), F.col("max_f").alias("max_fuel_flow_kg_per_sec"),
        F.col("min_t").alias("min_temperature_fahrenheit"), F.col("max_t").alias("max_temperature_fahrenheit"),
        F.col("anomalies").alias("anomaly_count"), "pressure_anomalies", "fuel_anomalies", "temperature_anomalies",
        "earliest_reading_date", "latest_reading_date", F.col("with_id").alias("records_with_source_id"),
        F.col("first_created").alias("first_processed_at"), F.col("last_created").alias("last_processed_at")))
    return marts.engine_ranks(rows, as_of, workdir)


def kpis_from_partials(p: DataFrame) -> DataFrame:
    """I7 from partials: engines, flight-ready engines, the latest day and reading, without the fact table."""
    engines = p.groupBy("engine_id").agg(F.sum("anomalies").alias("a"), F.sum("n").alias("n")).select(
        engine_health(pct_half_up("a", F.col("n"))).alias("health_status"))
    return serving.kpis(engines, daily_trends_from_partials(p),
                        p.select(F.col("last_reading").alias("reading_timestamp")))


def daily_trends_from_partials(p: DataFrame, as_of=None) -> DataFrame:
    """The daily mart rebuilt from partials: the per-day aggregates in the shape of
    ``marts.daily_aggregates``, then the batch mart's own window and alert logic."""
    counts = ([a.lower() + "_anomalies" for a in rules.ANOMALY_TYPES]
              + [h.lower() + "_readings" for h in rules.READING_HEALTH_VALUES])
    p = _merged_stddev(p, "date_actual", "score")
    g = p.groupBy("date_actual").agg(
        F.sum("n").alias("total_readings"), F.sum("anomalies").alias("total_anomalies"),
        wide_sum("sum_score", 1).alias("_ss"), F.sum("_dev_score").alias("_dev"),
        F.min("min_score").alias("min_daily_performance_score"),
        F.max("max_score").alias("max_daily_performance_score"),
        F.count_distinct("engine_id").alias("active_engines"),
        *[F.sum(c).alias(c) for c in counts],
        F.min("first_created").alias("earliest_processing_time"),
        F.max("last_created").alias("latest_processing_time"))
    n = F.col("total_readings")
    avg_score = exact_avg("_ss", n, 5, 9, 1)
    d = g.select(
        "date_actual", day_of_week_sun0(F.col("date_actual").cast("timestamp_ntz")).alias("day_of_week"),
        day_of_week_sun0(F.col("date_actual").cast("timestamp_ntz")).isin(0, 6).alias("is_weekend"),
        n.cast("bigint").alias("total_readings"), F.col("total_anomalies").cast("bigint"),
        pct_half_up("total_anomalies", n).alias("daily_anomaly_rate_percent"),
        *[F.col(c).cast("bigint").alias(c) for c in counts[:6]],
        avg_score.alias("avg_daily_performance_score"),
        "min_daily_performance_score", "max_daily_performance_score",
        _stddev("total_readings", "_dev").alias("stddev_daily_performance"),
        F.col("active_engines").cast("bigint"),
        *[F.col(c).cast("bigint").alias(c) for c in counts[6:]],
        "earliest_processing_time", "latest_processing_time")
    return marts.daily_trend_windows(d, as_of)
