"""Values that hold CSV's own characters survive the clean CSV, and its files stay line by line."""

import json
import os

import pytest
from pyspark.sql import functions as F

from plume.operators import ingest
from plume.sources.csv import publish_clean_csv, read_clean_csv, write_clean_csv
from plume.sources.text import read_jsonl

ODD = ["a\nb", "a\r\nb", 'say "x"', "x,y", "\\", "\\n", "\\\\n\\", "\\\n", "tail\\", " lead", "tab\t", "é,\"\n\\r", "\\r\\n", "''"]


def test_round_trip_and_one_line_per_record(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    rows = [(f"2025-01-01T00:00:{i:02d}", v, "1", None, "3") for i, v in enumerate(ODD)]
    df = spark.createDataFrame(rows, "timestamp string, engine_id string, chamber_pressure string, fuel_flow string, temperature string")
    write_clean_csv(df, path)
    assert sorted(map(tuple, read_clean_csv(spark, path).collect())) == sorted(rows)
    texts = [open(os.path.join(path, f), newline="").read() for f in os.listdir(path) if f.endswith(".csv")]
    assert sum(t.count("\n") for t in texts) == len(rows) + len(texts)          # a header in each part
    assert not any("\r" in t for t in texts)


def test_publication_is_whole_or_not_at_all(spark, tmp_dir):
    path = os.path.join(tmp_dir, "out", "csv")
    schema = "timestamp string, engine_id string, chamber_pressure string, fuel_flow string, temperature string"

    def rows(*ids):
        return spark.createDataFrame([("2025-01-01T00:00:00", i, "1", None, "3") for i in ids], schema)

    def held():
        assert os.listdir(os.path.dirname(path)) == ["csv"]
        return sorted(r.engine_id for r in read_clean_csv(spark, path).collect())

    assert publish_clean_csv(rows(), path) == 0 and not os.path.exists(path)        # no record: nothing is written
    assert publish_clean_csv(rows("a", "b"), path) == 2 and held() == ["a", "b"]
    assert publish_clean_csv(rows("c"), path) == 1 and held() == ["c"]
    assert publish_clean_csv(rows(), path) == 0 and held() == ["c"]
    with pytest.raises(Exception):
        publish_clean_csv(rows("d").withColumn("engine_id", F.raise_error(F.lit("lost"))), path)
    assert held() == ["c"]
    os.rename(path, path + ".former")                                               # killed between its renames
    assert publish_clean_csv(rows(), path) == 0 and held() == ["c"]


def test_batch_job_with_odd_values(spark, tmp_dir):
    from plume.plans.jobs import run_batch
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        for i, v in enumerate(ODD):
            f.write(json.dumps({"timestamp": f"2025-01-01T00:00:{i:02d}", "engine_id": v, "chamber_pressure": 200, "fuel_flow": 100,
                                "temperature": 3000}) + "\r\n")
    from plume.sources import fixtures
    res = run_batch(spark, src, os.path.join(tmp_dir, "out"), fixtures.dim_engines(spark), fixtures.dim_metrics(spark),
                    table_prefix="odd")
    assert res["summary"]["valid_records"] == len(ODD) and res["failed_tests"] == []
    assert spark.table("odd_fact").count() == len(ODD)


def test_audit_keeps_duplicates_with_a_null_engine_and_the_record(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    line = '{"timestamp": "2025-01-01T00:00:00", "engine_id": null, "chamber_pressure": 1}'
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        f.write("\n".join([line, line, line, '{"engine_id": "x"}', "{oops"]) + "\n")
    lines = read_jsonl(spark, src)
    rows = ingest.audit(lines).collect()
    assert sum(r["rule"] == "duplicate_removed" for r in rows) == 2
    assert ingest.summary_from_lines(lines).first()["duplicate_records"] == 2
    assert {r["record"] for r in rows if r["rule"] == "missing_required"} == {'{"engine_id": "x"}'}
    assert {r["record"] for r in rows if r["rule"] == "parse_error"} == {"{oops"}
