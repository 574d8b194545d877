"""A3 across syncs: loads, reloads and partial reloads equal a from-scratch load."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from plume.schemas import RAW_SCHEMA
from plume.sources.generations import RawTable


def delivery(spark, ids, generation, value="1", day=0):
    at = dt.datetime(2025, 1, 1) + dt.timedelta(days=generation + day)
    return spark.createDataFrame([(f"id{i}", at, generation, "E", "t", value, value, value) for i in ids], RAW_SCHEMA)


def contents(table):
    return sorted((r[0], r[2], r[5]) for r in table.rows().collect())


def test_reload_and_partial_reload(spark, tmp_dir):
    t = RawTable(spark, tmp_dir)
    with pytest.raises(LookupError):
        t.rows()
    t.load(delivery(spark, range(5), 1), full=True)
    once = contents(t)
    assert once == [(f"id{i}", 1, "1") for i in range(5)]
    t.load(delivery(spark, range(5), 1))
    assert contents(t) == once
    t.load(delivery(spark, [1, 2, 9], 2, "2"))
    t.load(delivery(spark, [2], 1, "0", day=50))                      # older generation, later extraction
    scratch = RawTable(spark, os.path.join(tmp_dir, "scratch"))
    scratch.load(delivery(spark, [0, 3, 4], 1).unionByName(delivery(spark, [1, 2, 9], 2, "2")), full=True)
    assert contents(t) == contents(scratch)
    t.compact()
    assert contents(t) == contents(scratch)
    assert spark.read.parquet(f"{t.committed()[1]}/loads").count() == 1
    t.load(delivery(spark, [7], 1))                                    # compaction makes nothing stale
    assert ("id7", 1, "1") in contents(t)


def test_a_full_load_removes_absent_ids_and_stays(spark, tmp_dir):
    t = RawTable(spark, tmp_dir)
    t.load(delivery(spark, range(4), 1), full=True)
    t.load(delivery(spark, [0, 1], 3, "3"), full=True)
    t.load(delivery(spark, [0, 2], 2, "2", day=90))                    # stale: before the full load's generation
    assert contents(t) == [("id0", 3, "3"), ("id1", 3, "3")]
    with pytest.raises(ValueError):
        t.load(delivery(spark, [0], 2), full=True)
    with pytest.raises(ValueError):
        t.load(delivery(spark, [0], 4).withColumn("_airbyte_raw_id", F.lit(None).cast("string")))
    assert contents(t) == [("id0", 3, "3"), ("id1", 3, "3")]
    t.load(delivery(spark, [], 4), full=True)
    assert contents(t) == []
    assert len(os.listdir(os.path.join(tmp_dir, "loads"))) <= 4       # what two versions can read


def test_repeated_ids_of_one_load_have_one_winner(spark, tmp_dir):
    t = RawTable(spark, tmp_dir)
    both = delivery(spark, [1], 1, "a").unionByName(delivery(spark, [1], 1, "b")).unionByName(delivery(spark, [1], 1, "b"))
    t.load(both.repartition(3), full=True)
    first = contents(t)
    t.load(both.coalesce(1))
    assert len(first) == 1 and contents(t) == first


def test_a_load_that_dies_changes_nothing(spark, tmp_dir, monkeypatch):
    t = RawTable(spark, tmp_dir)
    t.load(delivery(spark, [1], 1), full=True)

    def die(*a):
        raise OSError("lost")

    monkeypatch.setattr(t, "_commit", die)
    with pytest.raises(OSError):
        t.load(delivery(spark, [1, 2], 2, "2"))
    assert contents(t) == [("id1", 1, "1")]
    monkeypatch.undo()
    t.load(delivery(spark, [1, 2], 2, "2"))
    assert contents(t) == [("id1", 2, "2"), ("id2", 2, "2")]
