"""The reading ledger: on time + duplicate + late = input; nothing on time is missing from the stream's dedup."""

import os

import pytest
from pyspark.sql import functions as F

from plume.streaming import streams
from plume.streaming.ledger import ReadingLedger

LINE = '{{"timestamp": "2025-01-01T{}", "engine_id": {}, "chamber_pressure": {}, "fuel_flow": 100, "temperature": 3000}}'


def _line(time, engine='"TRE-001"', pressure=200):
    return LINE.format(time, engine, pressure)


BATCHES = [
    [_line("10:00:00"), _line("10:00:00", pressure=9), _line("08:00:00"), "{bad", _line("09:30:00", "null"), _line("09:30:00", "null")],
    [_line("12:00:00"), _line("09:00:00"), _line("09:00:00.001"), _line("10:00:00"), _line("09:30:00", "null"), _line("07:00:00")],
    ["{bad", _line("xx")],
    [_line("10:59:59"), _line("11:30:00"), _line("11:30:00"), _line("12:00:00"), _line("10:59:59")],
]


def _batch(spark, lines):
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, _ord long").coalesce(1)
    return streams.clean_stream(df)


def _balance(ledger):
    return [tuple(r) for r in ledger.balance().select("batch", "input", "on_time", "duplicate", "late").orderBy("batch").collect()]


EXPECTED = [(0, 5, 3, 2, 0), (1, 6, 2, 2, 2), (2, 0, 0, 0, 0), (3, 5, 1, 2, 2)]


def test_every_valid_reading_is_accounted_for(spark, tmp_dir):
    ledger = ReadingLedger(spark, tmp_dir, "1 hour")
    for i, lines in enumerate(BATCHES):
        ledger(_batch(spark, lines), i)
    ledger(_batch(spark, BATCHES[0]), 0)                               # replayed: nothing happens
    assert _balance(ledger) == EXPECTED
    late = {(r.timestamp, r.lateness_us) for r in ledger.rows("late").collect()}
    assert late == {("2025-01-01T09:00:00", 0), ("2025-01-01T07:00:00", 7_200_000_000), ("2025-01-01T10:59:59", 1_000_000)}
    assert ledger.rows("late").count() == 4                            # repeated late rows are all kept
    first = ledger.rows("on_time").where("timestamp = '2025-01-01T10:00:00'").first()
    assert (first.chamber_pressure, first.copies) == ("200", 1)
    # only keys after the watermark stay in the state
    assert ledger.read("seen").agg(F.min("_event_time")).first()[0].hour >= 11
    assert not os.path.exists(os.path.join(tmp_dir, "work"))


@pytest.mark.parametrize("step", ["_conclude", "_commit"])
def test_a_crash_and_retry_counts_once(spark, tmp_dir, monkeypatch, step):
    ledger = ReadingLedger(spark, tmp_dir, "1 hour")
    ledger(_batch(spark, BATCHES[0]), 0)

    def die(*a):
        raise OSError("lost")

    monkeypatch.setattr(ledger, step, die)
    with pytest.raises(OSError):
        ledger(_batch(spark, BATCHES[1]), 1)
    monkeypatch.undo()
    assert _balance(ledger) == EXPECTED[:1] and ledger.rows("late").count() == 0
    ledger(_batch(spark, BATCHES[1]), 1)
    assert _balance(ledger) == EXPECTED[:2] and ledger.rows("late").count() == 2


def test_the_streams_dedup_keeps_all_on_time_rows_and_no_others_but_late_ones(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i, lines in enumerate(BATCHES):
        with open(os.path.join(src, f"{i}.jsonl"), "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(os.path.join(src, f"{i}.jsonl"), (1_700_000_000 + i, 1_700_000_000 + i))

    def validated():
        return streams.clean_stream(streams.read_lines_stream(spark, src, max_files_per_trigger=1))

    ledger = ReadingLedger(spark, os.path.join(tmp_dir, "ledger"), "1 hour")
    q = (validated().writeStream.foreachBatch(ledger).option("checkpointLocation", os.path.join(tmp_dir, "c1"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    out = os.path.join(tmp_dir, "dedup")
    streams.start_to_table(streams.dedup_stream(validated(), "1 hour"), out, os.path.join(tmp_dir, "c2")).awaitTermination(120)
    assert _balance(ledger) == EXPECTED

    def keys(df):
        return {(r.timestamp, r.engine_id) for r in df.collect()}

    kept, on_time = keys(spark.read.parquet(out)), keys(ledger.rows("on_time"))
    assert on_time <= kept and kept - on_time <= keys(ledger.rows("late"))
