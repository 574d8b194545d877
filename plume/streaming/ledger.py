"""K2, K3: where every valid reading of a stream went, the late ones included.

Spark's stateful operators drop rows behind the watermark without a trace. ``ReadingLedger`` is a
``foreachBatch`` sink that deduplicates as ``streams.dedup_stream`` does and keeps them. Its watermark
counts every committed batch; Spark's own filter lags one batch behind that (and catches up in batches
without data), so a row between the two passes ``dedup_stream`` and is late here. Where the count
matters, take ``rows("on_time")`` as the stream's output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume import rules
from plume.functions.columns import ntz_literal
from plume.operators import ingest
from plume.operators.versions import Committed
from plume.streaming.streams import DEFAULT_WATERMARK

ON_TIME, DUPLICATE, LATE = "on_time", "duplicate", "late"
_KEY = ["timestamp", "engine_id"]
_ROWS = "timestamp string, engine_id string, _event_time timestamp_ntz, copies bigint, attempt string, batch bigint, outcome string"
_BALANCE = "batch bigint, attempt string, input bigint, on_time bigint, duplicate bigint, late bigint, watermark timestamp_ntz"


class ReadingLedger(Committed):
    """Sink of ``streams.clean_stream``: each valid reading of a batch is on time, a duplicate or late.

    *Late*: its event time is not after the watermark, the largest event time of the committed
    batches (whole milliseconds) less ``watermark``; each late row is kept with its lateness.
    *Duplicate*: a row whose (timestamp text, engine id) was on time before, in this batch or an
    earlier one; NULL ids are equal. They are counted per key, so a key with a third of all rows is
    combined map-side and meets no other row in a join. *On time*: the first row of any other key.
    ``balance`` has one row per committed batch: input = on_time + duplicate + late.

    Under ``base``: ``rows/`` (files are only added; each row names batch and attempt), and per
    version the keys that a later row may still repeat, those after the watermark, and ``balance``.
    A batch costs work in proportion to itself and to the keys inside the watermark. An attempt
    that dies leaves rows that no committed balance names; they are not read.
    """

    def __init__(self, spark: SparkSession, base: str, watermark: str = DEFAULT_WATERMARK):
        super().__init__(spark, base)
        self.delay = F.expr(f"INTERVAL {watermark}")

    def balance(self) -> DataFrame:
        """Per committed batch: input, on_time, duplicate, late, and the watermark after it."""
        return self.read("balance").drop("attempt")

    def rows(self, outcome: str) -> DataFrame:
        """Rows of committed batches: ``on_time`` and ``duplicate`` one per key and batch (``copies``: how
        many rows of the batch were removed as its duplicates), ``late`` one per row (``lateness_us``)."""
        mine = self.read("balance").select("batch", "attempt")
        return (self.spark.read.parquet(f"{self.base}/rows").where(F.col("outcome") == outcome)
                .join(mine, ["batch", "attempt"], "left_semi").drop("attempt", "outcome"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        state = self.committed()
        if state and batch_id <= state[0]:
            return                              # committed before the stream could say so
        attempt, spark = uuid.uuid4().hex, self.spark
        mark = spark.read.parquet(f"{state[1]}/balance").agg(F.max("watermark")).first()[0] if state else None
        mark = _ntz(mark)
        work = f"{self.base}/work/{batch_id}-{attempt}"
        # parsed once; the place in this table decides which copy is first
        (ingest.emit_rows(batch, F.col("_status").isNull(), *rules.CSV_COLUMNS, "_event_time")
         .withColumn("_n", F.monotonically_increasing_id()).write.parquet(work))
        valid = spark.read.parquet(work)
        late = F.coalesce(F.col("_event_time") <= mark, F.lit(False))
        firsts = (valid.where(~late).groupBy(*_KEY)
                  .agg(F.min_by(F.struct(*[c for c in valid.columns if c not in (*_KEY, "_n")]), "_n").alias("_first"),
                       F.count(F.lit(1)).alias("_rows")).select(*_KEY, "_first.*", "_rows"))
        if state:
            seen = spark.read.parquet(f"{state[1]}/seen").select(*[F.col(c).alias(f"_{c}") for c in _KEY], F.lit(True).alias("_seen"))
            firsts = firsts.join(seen, (F.col("timestamp") == F.col("_timestamp")) & F.col("engine_id").eqNullSafe(F.col("_engine_id")),
                                 "left").drop("_timestamp", "_engine_id")
        else:
            firsts = firsts.withColumn("_seen", F.lit(None).cast("boolean"))
        kept = firsts.select(*rules.CSV_COLUMNS, "_event_time", F.lit(None).cast("bigint").alias("lateness_us"),
                             (F.col("_rows") - F.when(F.col("_seen"), 0).otherwise(1)).cast("bigint").alias("copies"),
                             F.when(F.col("_seen"), DUPLICATE).otherwise(ON_TIME).alias("outcome"))
        behind = valid.where(late).select(
            *rules.CSV_COLUMNS, "_event_time",
            (F.unix_micros(mark.cast("timestamp")) - F.unix_micros(F.col("_event_time").cast("timestamp"))).alias("lateness_us"),
            F.lit(0).cast("bigint").alias("copies"), F.lit(LATE).alias("outcome"))
        (kept.unionByName(behind).withColumn("batch", F.lit(batch_id).cast("bigint")).withColumn("attempt", F.lit(attempt))
         .write.mode("append").partitionBy("batch", "outcome").parquet(f"{self.base}/rows"))
        self._conclude(valid, state, batch_id, attempt, mark)

    def _conclude(self, valid: DataFrame, state, batch_id: int, attempt: str, mark) -> None:
        spark, version = self.spark, f"{self.base}/versions/{batch_id}-{attempt}"
        after = F.greatest(mark, F.date_trunc("millisecond", F.max("_event_time")).cast("timestamp_ntz") - self.delay)
        n_input, watermark = valid.agg(F.count(F.lit(1)), after).first()
        fs, path = self._fs(f"{self.base}/rows/batch={batch_id}")
        if fs.exists(path):
            rows = spark.read.schema(_ROWS).option("basePath", f"{self.base}/rows").parquet(path.toString())
        else:                                   # a batch without a valid record writes no row
            rows = spark.createDataFrame([], _ROWS)
        mine = rows.where(F.col("attempt") == attempt)
        split = mine.agg(F.count_if(F.col("outcome") == ON_TIME), F.coalesce(F.sum("copies"), F.lit(0)),
                         F.count_if(F.col("outcome") == LATE)).first()
        balance = spark.createDataFrame([(batch_id, attempt, n_input, *split, watermark)], _BALANCE)
        seen = mine.where(F.col("outcome") == ON_TIME).select(*_KEY, "_event_time")
        if state:
            balance = balance.unionByName(spark.read.parquet(f"{state[1]}/balance"))
            seen = seen.unionByName(spark.read.parquet(f"{state[1]}/seen"))
        balance.coalesce(1).write.parquet(f"{version}/balance")
        seen.where(F.col("_event_time") > _ntz(watermark)).write.parquet(f"{version}/seen")
        self._commit(batch_id, attempt)
        self._prune()


def _ntz(value):
    return F.lit(None).cast("timestamp_ntz") if value is None else ntz_literal(value)
