"""Seeded synthetic telemetry as a Spark job.

Every random draw is a function of ``(seed, reading id, draw name)`` through
``xxhash64``, so a reading is the same whichever task computes it, however the
ids are partitioned, and after any task retry. No driver loop, no Python UDF.

The time line (each reading 1-5 s after the previous one) is a global running
sum. It is computed in blocks of ids: a running sum inside each block (one
window partition per block), plus the total of all earlier blocks (a running
sum over one row per block, at most ``MAX_BLOCKS`` rows), joined back on the
block number.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plume import rules
from plume.functions.columns import ntz_literal

# FIXED VALUES: engine configuration (performance factor, failure rate)
ENGINES = (
    ("TRE-001", 0.88, 0.12),
    ("TRE-002", 0.75, 0.18),
    ("TRE-003", 0.92, 0.08),
    ("TRE-004", 0.82, 0.15),
    ("TRE-005", 0.85, 0.13),
)
# FIXED VALUES: operating ranges and anomaly rates
PRESSURE_RANGE = (150, 300)
FUEL_RANGE = (50, 150)
TEMPERATURE_RANGE = (2000, 4000)
MISSING_RATE = 0.03
OUT_OF_RANGE_RATE = 0.05
DUPLICATE_RATE = 0.04
CRITICAL_FACTOR = 0.02
PRESSURE_NOISE, FUEL_NOISE, TEMPERATURE_NOISE = 10.0, 8.0, 50.0
MIN_TEMPERATURE = 500

BLOCK = 10_000           # smallest block of ids for the running time line
MAX_BLOCKS = 100_000     # the block-offset window never sees more rows than this
_MASK53 = (1 << 53) - 1


def uniform(seed: int, draw: str, id_col: str = "id") -> Column:
    """U[0,1) from the hash of (seed, draw, id)."""
    h = F.xxhash64(F.lit(seed), F.lit(draw), F.col(id_col))
    return h.bitwiseAND(F.lit(_MASK53)).cast("double") / float(1 << 53)


def normal(seed: int, draw: str, id_col: str = "id") -> Column:
    """N(0,1) by Box-Muller from two hash uniforms."""
    u1 = F.lit(1.0) - uniform(seed, draw + ".1", id_col)          # (0, 1]
    u2 = uniform(seed, draw + ".2", id_col)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def _between(u: Column, lo: float, hi: float) -> Column:
    return F.lit(lo) + u * F.lit(hi - lo)


def _timeline(ids: DataFrame, seed: int, start: _dt.datetime, n: int | None = None) -> DataFrame:
    """Add ``timestamp``: start + sum of U(1,5) s steps for all earlier ids (first step 0).

    With ``n`` (the number of ids) the block size grows so that there are at most
    ``MAX_BLOCKS`` blocks: the window over block totals stays bounded, and each
    block's own window holds ``n / MAX_BLOCKS`` rows at most.
    """
    block = BLOCK if n is None else max(BLOCK, -(-n // MAX_BLOCKS))
    step = F.when(F.col("id") > 0, _between(uniform(seed, "step"), 1.0, 5.0)).otherwise(F.lit(0.0))
    df = ids.withColumn("_step", step).withColumn("_block", F.floor(F.col("id") / block))
    in_block = Window.partitionBy("_block").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_run", F.sum("_step").over(in_block))
    totals = df.groupBy("_block").agg(F.sum("_step").alias("_total"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_block", F.coalesce(F.sum("_total").over(earlier), F.lit(0.0)).alias("_offset"))
    df = df.join(offsets, "_block")
    micros = F.round((F.col("_offset") + F.col("_run")) * 1_000_000).cast("long")
    # wall-clock arithmetic on timestamp_ntz: independent of the session time zone
    return df.withColumn("timestamp", F.timestamp_add("MICROSECOND", micros, ntz_literal(start))) \
        .drop("_step", "_block", "_run", "_offset")


def generate_readings(ids: DataFrame, seed: int = 42, start: _dt.datetime | None = None,
                      n: int | None = None) -> DataFrame:
    """Synthetic readings for ``ids`` (a DataFrame with a long ``id`` column, 0..n-1;
    pass ``n`` when known so the time-line blocks scale with it).

    Returns ``id, _ord, timestamp, engine_id, chamber_pressure, fuel_flow, temperature``
    (NULL = key removed), duplicates included (``_ord`` after all originals).
    """
    start = start or _dt.datetime(2025, 1, 1)
    cfg = ids.sparkSession.createDataFrame(
        [(i, e, p, f) for i, (e, p, f) in enumerate(ENGINES)],
        "_engine_ix int, engine_id string, _perf double, _fail double")
    u = lambda name: uniform(seed, name)
    df = _timeline(ids.select(F.col("id").cast("long")), seed, start, n)
    df = df.withColumn("_engine_ix", F.floor(u("engine") * len(ENGINES)).cast("int"))
    # a 5-row table: broadcasting it is bounded by construction
    df = df.join(F.broadcast(cfg), "_engine_ix")

    perf = F.col("_perf")
    p = F.greatest(F.lit(0.0), _between(perf, *PRESSURE_RANGE) + normal(seed, "p") * PRESSURE_NOISE)
    fl = F.greatest(F.lit(0.0), _between(perf, *FUEL_RANGE) + normal(seed, "f") * FUEL_NOISE)
    temp_factor = F.lit(1.0) + F.lit(0.3) * (F.lit(1.0) - perf)
    t = F.greatest(F.lit(float(MIN_TEMPERATURE)),
                   F.lit(float(TEMPERATURE_RANGE[0])) + temp_factor * (TEMPERATURE_RANGE[1] - TEMPERATURE_RANGE[0])
                   + normal(seed, "t") * TEMPERATURE_NOISE)
    df = df.withColumn("_p", p).withColumn("_f", fl).withColumn("_t", t)

    critical = u("critical") < F.col("_fail") * CRITICAL_FACTOR
    missing = ~critical & (u("missing") < MISSING_RATE)
    out_of_range = ~critical & ~missing & (u("oor") < OUT_OF_RANGE_RATE)
    kind = F.floor(u("kind") * 4).cast("int")           # critical failure kind
    field = F.floor(u("field") * 3).cast("int")         # which measure
    pick = u("pick") < 0.5                              # which of two alternatives
    v = u("value")
    n_drop = F.floor(u("ndrop") * 2).cast("int") + 1     # drop 1 or 2 measures

    pressure = (F.when(critical & (kind == 1), _between(v, 400, 600))
                .when(critical & (kind == 3), _between(v, -50, 50))
                .when(out_of_range & (field == 0),
                      F.when(pick, _between(v, -100, -10)).otherwise(_between(v, 500, 1000)))
                .otherwise(F.col("_p")))
    fuel = (F.when(critical & (kind == 0), F.lit(0.0))
            .when(out_of_range & (field == 1), F.when(pick, F.lit(0.0)).otherwise(_between(v, 300, 500)))
            .otherwise(F.col("_f")))
    temperature = (F.when(critical & (kind == 2), _between(v, 5000, 8000))
                   .when(out_of_range & (field == 2),
                         F.when(pick, _between(v, -300, 0)).otherwise(_between(v, 8000, 12000)))
                   .otherwise(F.col("_t")))

    def keep(ix: int) -> Column:
        # drop one field (= field) or keep only one field (= field)
        dropped = F.when(n_drop == 1, field == ix).otherwise(field != ix)
        return ~(missing & dropped)

    readings = df.select(
        "id", F.col("id").alias("_ord"), "timestamp", "engine_id",
        F.when(keep(0), pressure).alias("chamber_pressure"),
        F.when(keep(1), fuel).alias("fuel_flow"),
        F.when(keep(2), temperature).alias("temperature"),
        (u("dup") < DUPLICATE_RATE).alias("_dup"),
    )
    n_hint = F.lit(1 << 40)
    dups = readings.where("_dup").withColumn("_ord", F.col("_ord") + n_hint)
    return readings.unionByName(dups).drop("_dup")


def to_jsonl(readings: DataFrame) -> DataFrame:
    """Render readings as JSON Lines ``(value, _ord)``; absent measures are left out."""
    ts = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rec = F.struct(ts.alias("timestamp"), "engine_id", *[F.col(c) for c in rules.MEASURE_FIELDS])
    return readings.select(F.to_json(rec).alias("value"), "_ord")


def generate_jsonl(spark, n: int, seed: int = 42, start: _dt.datetime | None = None) -> DataFrame:
    """B1: ``n`` readings (default in the reference: 100) as JSON Lines."""
    return to_jsonl(generate_readings(spark.range(n), seed, start, n=n))
