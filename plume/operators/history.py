"""A10, F1: engine dimension history (slowly changing dimension, type 2), and measures calibrated by the bridge.

``merge_versions`` takes one delivery of the engine dimension into its history; ``valid_at`` finds
the version that was valid when a reading was taken; ``calibrated`` applies the bridge's factors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.operators.dims import with_engine_defaults
from plume.operators.keys import global_row_number, written
from plume.schemas import DIM_ENGINES_SCHEMA

END_OF_TIME = _dt.date(2999, 12, 31)
#: What a version is about: a change of any of these opens a new one.
ATTRIBUTES = ("engine_name", "engine_type", "manufacturer", "max_chamber_pressure_psi", "max_fuel_flow_kg_per_sec",
              "max_temperature_fahrenheit", "installation_date", "last_maintenance_date", "operational_status", "source_system")
_COLUMNS = [f.name for f in DIM_ENGINES_SCHEMA.fields]
_COMPARED = "_attributes"


def _filled(engines: DataFrame) -> DataFrame:
    for f in DIM_ENGINES_SCHEMA.fields:
        if f.name not in engines.columns:
            engines = engines.withColumn(f.name, F.lit(None).cast(f.dataType))
    return with_engine_defaults(engines).select(*[F.col(f.name).cast(f.dataType) for f in DIM_ENGINES_SCHEMA.fields])


def merge_versions(history: DataFrame, delivery: DataFrame, as_of: _dt.date, full: bool = False,
                   workdir: str | None = None) -> DataFrame:
    """``history`` after a delivery that holds from the date ``as_of`` on.

    An engine whose attributes are those of its current version is left alone (so a delivery can be
    merged again); a changed one has its current version closed on the day before and a new one
    opened; a new one is opened; an engine that the delivery lacks stays, or with ``full`` is
    closed. A second change on the day a version began replaces that version in place, so no
    interval is empty and an engine's intervals follow one another without a gap. Keys of new
    versions continue after the largest key. Attributes are compared null-safe, after defaults.
    Raises ValueError where the delivery repeats an engine or lacks an id, or is older than a
    version that it would change. ``history`` may be empty; the result is written once.
    """
    history, new = _filled(history), _filled(delivery)
    new = new.select("engine_id", F.struct(*ATTRIBUTES).alias(_COMPARED))
    bad = new.groupBy("engine_id").count().where("engine_id IS NULL OR count > 1").first()
    if bad:
        raise ValueError(f"delivery: engine_id {bad[0]!r} occurs {bad[1]} times")
    day, before = F.lit(as_of).cast("date"), F.lit(as_of - _dt.timedelta(days=1)).cast("date")
    old = history.where("is_current").select("engine_id", F.struct(*ATTRIBUTES).alias("_old"), "effective_from_date")
    # one row per engine: what becomes of it
    change = written(old.join(new.withColumn("_there", F.lit(True)), "engine_id", "full").select(
        "engine_id", _COMPARED, "effective_from_date",
        F.when(F.col("effective_from_date").isNull(), "open")
        .when(F.col("_there").isNull(), F.lit("close" if full else "keep"))
        .when(F.col("_old").eqNullSafe(F.col(_COMPARED)), "keep")
        .when(F.col("effective_from_date") == day, "replace").otherwise("change").alias("_change"))
        .where("_change <> 'keep'"), "engine-changes", workdir)
    late = change.where(F.col("effective_from_date") > day).first()
    if late:
        raise ValueError(f"delivery of {as_of}: the version of {late['engine_id']!r} begins on {late['effective_from_date']}")
    stamp = F.lit(as_of).cast("timestamp_ntz")
    joined = history.alias("h").join(change.select(F.col("engine_id").alias("_id"), "_change", _COMPARED),
                                     (F.col("engine_id") == F.col("_id")) & F.col("is_current"), "left")
    shut = F.col("_change").isin("change", "close")
    swap = F.col("_change") == "replace"
    # a version that began today and is closed today would be empty: it goes
    kept = joined.where(~(F.coalesce(F.col("_change"), F.lit("")) == "close") | (F.col("effective_from_date") < day)).select(*[
        F.when(shut, before).otherwise(F.col(c)).alias(c) if c == "effective_to_date"
        else (F.col(c) & ~F.coalesce(shut, F.lit(False))).alias(c) if c == "is_current"
        else F.when(shut | swap, stamp).otherwise(F.col(c)).alias(c) if c == "updated_at"
        else F.when(swap, F.col(f"{_COMPARED}.{c}")).otherwise(F.col(c)).alias(c) if c in ATTRIBUTES
        else F.col(c) for c in _COLUMNS])
    largest = history.agg(F.coalesce(F.max("engine_key"), F.lit(0))).first()[0]
    opened = global_row_number(change.where("_change IN ('open', 'change')"), ["engine_id"], "_n", workdir=workdir).select(
        (F.col("_n") + largest).cast("int").alias("engine_key"), "engine_id", *[f"{_COMPARED}.{c}" for c in ATTRIBUTES],
        day.alias("effective_from_date"), F.lit(END_OF_TIME).cast("date").alias("effective_to_date"),
        F.lit(True).alias("is_current"), stamp.alias("created_at"), stamp.alias("updated_at"))
    return written(kept.unionByName(opened).select(*_COLUMNS), "engine-history", workdir)


def valid_at(readings: DataFrame, history: DataFrame, columns=("engine_key",), time: str = "reading_timestamp") -> DataFrame:
    """``readings`` with ``columns`` of the engine version whose interval holds the reading's date.

    One row in, one row out: intervals of an engine do not overlap. NULL where no version was valid.
    An equi-join on the engine with the interval as its residual condition; Spark broadcasts the
    history while its size statistics allow it.
    """
    h = history.select(F.col("engine_id").alias("_id"), F.col("effective_from_date").alias("_from"),
                       F.col("effective_to_date").alias("_to"), *columns)
    taken = F.to_date(time)
    return readings.join(h, (F.col("engine_id") == F.col("_id")) & (taken >= F.col("_from")) & (taken <= F.col("_to")),
                         "left").drop("_id", "_from", "_to")


#: Metric names of the three measures.
MEASURE_METRICS = (("chamber_pressure_psi", "chamber_pressure"), ("fuel_flow_kg_per_sec", "fuel_flow"),
                   ("temperature_fahrenheit", "temperature"))


def calibrated(readings: DataFrame, bridge: DataFrame, metrics: DataFrame) -> DataFrame:
    """``readings`` (with ``engine_key``) and ``calibrated_<measure>``: the measure times the bridge's factor
    for its (engine, metric) pair, rounded half-up to three places; without a pair, or with a NULL
    factor, the measure itself.

    The bridge is pivoted to one row per engine, so readings are joined once and never multiplied;
    a pair that occurs twice raises ValueError.
    """
    again = bridge.groupBy("engine_key", "metric_key").count().where("count > 1").first()
    if again:
        raise ValueError(f"bridge: pair ({again[0]}, {again[1]}) occurs {again[2]} times")
    named = bridge.join(metrics.select("metric_key", "metric_name"), "metric_key")
    factors = named.groupBy(F.col("engine_key").alias("_engine")).agg(*[
        F.max(F.when(F.col("metric_name") == name, F.col("calibration_factor"))).alias(f"_factor_{m}")
        for m, name in MEASURE_METRICS])
    out = readings.join(factors, F.col("engine_key") == F.col("_engine"), "left").drop("_engine")
    for m, _ in MEASURE_METRICS:
        factor = F.coalesce(F.col(f"_factor_{m}"), F.lit(1).cast("decimal(8,6)"))
        out = out.withColumn(f"calibrated_{m}", F.round(F.col(m) * factor, 3).cast("decimal(14,3)")).drop(f"_factor_{m}")
    return out
