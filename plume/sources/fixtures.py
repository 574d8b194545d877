"""Test inputs derived from the driver's tables, plus the dimension fixtures.

``readings_from_events`` is the telemetry mapping of FIXTURES.md §5: pure
integer/decimal arithmetic over ``events`` so that DuckDB can recompute it. Its
work grows with ``events``; no row is skipped.

``jsonl_from_events`` renders those readings as JSON Lines with deterministic
dirt (blank and comment lines, malformed JSON, missing keys, bad values,
duplicates) so the text ingest path can be checked against SQL on ``events``.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume import rules
from plume.schemas import BRIDGE_SCHEMA, DIM_ENGINES_SCHEMA, DIM_METRICS_SCHEMA

MEASURE_TYPE = "decimal(8,3)"


def _milli(x) -> int:
    return int(Decimal(str(x)) * 1000)


def readings_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, ...) -> raw_id, reading_timestamp, engine_id and 3 measures.

    The measures are ``decimal(8,3)`` and may be NULL (an absent sensor value). They are worked out
    in whole thousandths over named columns: with decimals throughout, the generated method passes
    the 8,000 bytes beyond which the JVM does not compile it.
    """
    eid = F.col("event_id")
    events = events.select("event_id", "ts", ((eid * 7919) % 1000).cast("int").alias("_h"),
                           (eid % 197).cast("int").alias("_m"), (eid % 5).cast("int").alias("_e"),
                           (eid % 7).cast("int").alias("_w"), F.dayofmonth("ts").alias("_d"))
    h, m, e, w, d = (F.col(c) for c in ("_h", "_m", "_e", "_w", "_d"))
    events = events.select("*", (d.isin(5, 20) & (eid % 50 == 13)).alias("_burst"),
                           (d.between(25, 28) & (eid % 2 == 0)).alias("_sag"))
    burst, sag = F.col("_burst"), F.col("_sag")
    not2 = e != 2

    def value(start, step=0) -> Column:
        return F.lit(_milli(start)) + h * _milli(step) if step else F.lit(_milli(start))

    def measure(milli: Column) -> Column:
        return (milli.cast("decimal(10,0)") * F.lit(Decimal("0.001"))).cast(MEASURE_TYPE)

    pressure = (
        F.when(m == 23, F.lit(None))
        .when((m == 3) & not2, value(30, "0.04"))
        .when((m == 11) & not2, value(410, "0.1"))
        .when(m == 17, value(-10, "-0.02"))
        .when(m == 59, value(0))
        .when(burst, value(410))
        .when(d.isin(10, 30) & (eid % 3 == 0), value(450))
        .when((d == 15) & (eid % 8 == 0), value(450))
        .when((e == 1) & w.isin(0, 1), value(420))
        .when((e == 3) & (w == 0), value(60))
        .when(sag, value(100))
        .otherwise(value(200, "0.1"))
    )
    fuel = (
        F.when(m == 61, F.lit(None))
        .when((m == 29) | burst, value(0))
        .when((m == 31) & not2, value(300, "0.1"))
        .when(m == 37, value(20))
        .when(m == 73, value(190))
        .otherwise(value(80, "0.05"))
    )
    temperature = (
        F.when(m == 67, F.lit(None))
        .when((m == 41) & not2, value(900, "0.1"))
        .when(((m == 43) & not2) | burst, value(4600, 1))
        .when(m == 47, value(-280))
        .when(m.isin(71, 73) | sag, value(4300))
        .otherwise(value(3000, "1.1"))
    )
    engine = F.when(eid % 11 == 10, F.lit(" tre-099 ")).otherwise(
        F.concat(F.lit("TRE-00"), (e + 1).cast("string")))
    return events.select(
        eid.cast("string").alias("raw_id"),
        eid.alias("event_id"),
        F.col("ts").alias("reading_timestamp"),
        engine.alias("engine_id"),
        measure(pressure).alias("chamber_pressure"),
        measure(fuel).alias("fuel_flow"),
        measure(temperature).alias("temperature"),
    )


def records_from_events(events: DataFrame) -> DataFrame:
    """The readings as cleaner input records (all text; NULL = key absent).

    Columns: ``_ord`` (input order), ``raw_id``, the 5 record fields as strings and
    ``_has_<field>`` presence flags, the shape ``plume.operators.ingest`` works on.
    """
    r = readings_from_events(events)
    cols = [
        F.col("event_id").alias("_ord"),
        F.col("raw_id"),
        F.date_format("reading_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("engine_id"),
    ] + [F.col(c).cast("string").alias(c) for c in rules.MEASURE_FIELDS]
    out = r.select(*cols)
    return out.select("*", *[F.col(c).isNotNull().alias(f"_has_{c}") for c in rules.CSV_COLUMNS])


# ---------------------------------------------------------------------------
# Dirty JSON Lines over events.
# Line kind by q = event_id % 89 (kinds 0..25). Every event with event_id % 25 = 0 and q >= 24,
# and every second one with a null engine (q = 4), gets a second line with the same key and
# pressure + 1; every even event adds one line of a single hot key (a third of all lines).
# Input order is (part, event_id): originals are part 0, second lines 1, hot lines 2.
# ---------------------------------------------------------------------------
DIRT_MOD = 89
DUP_MOD = 25
DUP_MIN_KIND = 24
NULL_ENGINE_KIND = 4
LINE_PARTS = 3
HOT_LINE = ('{"timestamp": "2024-01-05T00:00:00.000000", "engine_id": "HOT-1", "chamber_pressure": 200, '
            '"fuel_flow": 100, "temperature": 3000}')
# an engine id with a line break, quotes, a comma and a backslash, as JSON text
ODD_ENGINE_JSON = 'TRE-001\\n\\"x\\",\\\\y'


def _jfield(name: str, value: Column, quoted: bool) -> Column:
    """The field's JSON text; NULL where ``value`` is."""
    return F.concat(F.lit(f'"{name}": "'), value, F.lit('"')) if quoted else F.concat(F.lit(f'"{name}": '), value)


def jsonl_from_events(events: DataFrame) -> DataFrame:
    """Text lines ``(value, part, event_id)`` with known dirt, in input order of the last two.

    Built in named steps: every intermediate is a column referenced by name, so
    the optimizer never copies a large expression into several places, and few of them join
    texts, so that the generated method stays small enough for the JVM to compile.
    """
    r = records_from_events(events).withColumn("q", (F.col("_ord") % DIRT_MOD).cast("int"))
    q = F.col("q")
    ts = F.col("timestamp")
    h = (F.col("_ord") * 7919) % 1000
    steps = (
        r.withColumn("ts_text", F.when(q == 5, F.lit("yesterday"))
                     .when(q == 9, F.lit("2999-01-01T00:00:00"))
                     .otherwise(F.concat(ts, F.when(q == 6, "Z").when(q == 21, "+0000").when(q == 22, "000")
                                         .when(q == 23, "+99:99").otherwise(""))))
        .withColumn("p_out", F.when(q == 19, F.lit("-1")).otherwise(F.col("chamber_pressure")))
        .withColumn("f_out", F.when(q == 19, F.lit("0")).otherwise(F.col("fuel_flow")))
        .withColumn("t_out", F.when(q == 16, (F.lit(6000) + h).cast("string"))
                    .when(q == 17, F.lit("-273.15"))
                    .when(q == 18, F.lit("-273.16"))
                    .otherwise(F.col("temperature")))
        .withColumn("j_ts", F.when(q == 14, F.lit('"timestamp": 5'))
                    .otherwise(_jfield("timestamp", F.col("ts_text"), True)))
        .withColumn("j_eng", F.when(q == 3, F.lit(None).cast("string"))
                    .when(q == NULL_ENGINE_KIND, F.lit('"engine_id": null'))
                    .when(q == 25, F.lit(f'"engine_id": "{ODD_ENGINE_JSON}"'))
                    .otherwise(_jfield("engine_id", F.col("engine_id"), True)))
        .withColumn("j_p", F.when(q == 7, F.lit('"chamber_pressure": null'))
                    .otherwise(_jfield("chamber_pressure", F.col("p_out"), False)))
        .withColumn("j_f", F.when(q == 8, _jfield("fuel_flow", F.col("f_out"), True))
                    .when(q == 9, F.lit('"fuel_flow": "abc"'))
                    .otherwise(_jfield("fuel_flow", F.col("f_out"), False)))
        .withColumn("j_t", _jfield("temperature", F.col("t_out"), False))
        .withColumn("good", F.concat(F.lit("{"), F.concat_ws(", ", "j_ts", "j_eng", "j_p", "j_f", "j_t"),
                                     F.lit("}")))
    )
    good = F.col("good")
    line = (
        F.when(q == 0, F.lit(""))
        .when(q == 1, F.concat(F.lit("# note "), F.col("_ord").cast("string")))
        .when(q == 2, F.concat(F.lit('{"timestamp": "'), ts, F.lit('", "engine_id": ')))
        .when(q == 10, F.concat(F.lit("{'timestamp': '"), ts, F.lit("', 'engine_id': 'TRE-001'}")))
        .when(q == 12, F.lit("[1]"))
        .when(q == 13, F.lit("5"))
        .otherwise(F.concat(F.when(q == 20, "   ").otherwise(""), good,
                            F.when(q == 11, " x").when(q == 15, good).when(q == 20, "  ").otherwise("")))
    )
    originals = steps.select(line.alias("value"), F.lit(0).alias("part"), F.col("_ord").alias("event_id"))

    again = ((F.col("_ord") % DUP_MOD == 0) & (q >= DUP_MIN_KIND)) | ((q == NULL_ENGINE_KIND) & (F.col("_ord") % 2 == 0))
    dups = (steps.where(again)
            .withColumn("j_p", _jfield("chamber_pressure",
                                       (F.col("chamber_pressure").cast("decimal(9,3)") + 1).cast("string"),
                                       False))
            .select(F.concat(F.lit("{"), F.concat_ws(", ", "j_ts", "j_eng", "j_p", "j_f", "j_t"),
                             F.lit("}")).alias("value"), F.lit(1).alias("part"), F.col("_ord").alias("event_id")))
    hot = events.where(F.col("event_id") % 2 == 0).select(F.lit(HOT_LINE).alias("value"), F.lit(2).alias("part"),
                                                         "event_id")
    return originals.unionByName(dups).unionByName(hot)


# ---------------------------------------------------------------------------
# Dimension fixtures (FIXTURES.md §4). Content is ours; the schema follows the DDL.
# ---------------------------------------------------------------------------
_CREATED = _dt.datetime(2024, 1, 1, 0, 0, 0)


def dim_engines(spark: SparkSession, with_old_version: bool = True) -> DataFrame:
    rows = []
    for i, (engine_id, name) in enumerate(rules.ENGINE_NAMES, start=1):
        rows.append((i, engine_id, name, rules.ENGINE_TYPE, rules.MANUFACTURER, 350, 200, 4000,
                     _dt.date(2024, 1, 1), None, rules.OPERATIONAL_STATUS, _dt.date(2024, 1, 1),
                     _dt.date(2999, 12, 31), True, rules.DIM_SOURCE_SYSTEM, _CREATED, _CREATED))
    if with_old_version:
        engine_id, name = rules.ENGINE_NAMES[0]
        rows.append((len(rows) + 1, engine_id, name + " (old)", rules.ENGINE_TYPE, rules.MANUFACTURER,
                     350, 200, 4000, _dt.date(2023, 1, 1), None, "RETIRED", _dt.date(2023, 1, 1),
                     _dt.date(2023, 12, 31), False, rules.DIM_SOURCE_SYSTEM, _CREATED, _CREATED))
    return spark.createDataFrame(rows, DIM_ENGINES_SCHEMA)


METRICS = (
    # metric_key, name, category, unit, normal min/max, critical min/max
    (1, "chamber_pressure", "PRESSURE", "psi", "150", "300", "80", "400"),
    (2, "fuel_flow", "FLOW", "kg/s", "50", "150", "15", "220"),
    (3, "temperature", "TEMPERATURE", "F", "2000", "4000", "1200", "4500"),
)


def dim_metrics(spark: SparkSession, names=None) -> DataFrame:
    rows = []
    for key, name, cat, unit, nmin, nmax, cmin, cmax in METRICS:
        if names is not None and name not in names:
            continue
        rows.append((key, name, cat, f"{name} reading", unit, Decimal(nmin), Decimal(nmax),
                     Decimal(cmin), Decimal(cmax), 3, None, _CREATED, _CREATED))
    return spark.createDataFrame(rows, DIM_METRICS_SCHEMA)


def bridge_engine_metrics(engines: DataFrame, metrics: DataFrame) -> DataFrame:
    """All (current engine, metric) pairs; calibration factor defaults to 1.0.

    Both inputs are dimension tables of a handful of rows, so the cross product
    is bounded by their (checked) sizes.
    """
    pairs = (engines.where("is_current").select("engine_key", "engine_id")
             .crossJoin(metrics.select("metric_key", "metric_name")))
    return pairs.select(
        F.col("engine_key").cast("int"),
        F.col("metric_key").cast("int"),
        F.lit(Decimal("1.0")).cast("decimal(8,6)").alias("calibration_factor"),
        F.concat_ws("-", "engine_id", "metric_name").alias("sensor_id"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in BRIDGE_SCHEMA.fields])


#: Days on which the engine dimension is delivered anew, and how long a delivery looks back.
DELIVERY_DAYS = (_dt.date(2024, 1, 11), _dt.date(2024, 1, 21), _dt.date(2024, 1, 31))
DELIVERY_SPAN = 10


def engine_delivery(stg: DataFrame, day: _dt.date) -> DataFrame:
    """The engine dimension as of ``day``, derived from the staged readings of the ten days before:
    engines with readings, their status by whether the number of anomalies is even, and their pressure
    limit by the highest pressure in whole hundreds."""
    seen = stg.where((F.to_date("reading_timestamp") < F.lit(day))
                     & (F.to_date("reading_timestamp") >= F.lit(day - _dt.timedelta(days=DELIVERY_SPAN))))
    return seen.groupBy("engine_id").agg(
        F.when(F.count_if("is_anomaly") % 2 == 0, "ACTIVE").otherwise("MAINTENANCE").alias("operational_status"),
        (F.floor(F.max("chamber_pressure_psi") / 100) * 100).cast("int").alias("max_chamber_pressure_psi"))


def bridge_from_readings(fact: DataFrame, metrics: DataFrame) -> DataFrame:
    """Calibration factors derived from the fact: 1 + ((readings * metric_key) mod 97) / 10000 for each known
    engine and metric, without the pairs whose keys add up to a multiple of seven."""
    n = fact.where("engine_key > 0").groupBy("engine_key").agg(F.count(F.lit(1)).alias("n"))
    pairs = n.select("engine_key", "n", F.explode(F.array(*[F.lit(k) for k, *_ in METRICS])).alias("metric_key"))
    return (pairs.join(metrics.select("metric_key", "metric_name"), "metric_key")
            .where((F.col("engine_key") + F.col("metric_key")) % 7 != 0)
            .select("engine_key", "metric_key",
                    (1 + ((F.col("n") * F.col("metric_key")) % 97).cast("decimal(8,0)") / 10000).cast("decimal(8,6)").alias("calibration_factor"),
                    F.concat_ws("-", "engine_key", "metric_name").alias("sensor_id")))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
