"""Cleaner semantics (C1-C13) on hand-made lines covering every rule and boundary."""

import os

from pyspark.sql import functions as F

from plume.operators import ingest
from plume.sources.csv import read_clean_csv, write_clean_csv
from plume.sources.raw import raw_load
from plume.sources.text import read_jsonl

TS = "2025-01-01T00:00:0{}"


def obj(i, **kw):
    import json
    rec = {"timestamp": TS.format(i % 10), "engine_id": f"TRE-00{1 + i % 5}",
           "chamber_pressure": 200.0, "fuel_flow": 100.0, "temperature": 3000.0}
    for k, v in kw.items():
        if v is ...:
            rec.pop(k)
        else:
            rec[k] = v
    return json.dumps(rec)


def lines_df(spark, lines):
    return spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, _ord long")


def run(spark, lines):
    df = lines_df(spark, lines)
    v = ingest.validate(ingest.records_from_lines(ingest.classify_lines(df)))
    rows = {r["_ord"]: r for r in v.collect()}
    return df, rows


def test_line_kinds(spark):
    lines = ["", "   ", "# note", '{"timestamp": "2025-01-01T00:00:00", ', "[1]", '"abc"', "5", "null",
             "{'timestamp': '2025-01-01T00:00:00', 'engine_id': 'TRE-001'}",
             '{"timestamp": "2025-01-01T00:00:00", "engine_id": "TRE-001"} x',
             '{"a": 1}{"b": 2}', '{"a": 1}]', '{"a": NaN}', obj(1), "  " + obj(2) + "  "]
    c = {r["_ord"]: r["kind"] for r in ingest.classify_lines(lines_df(spark, lines)).collect()}
    assert [c[i] for i in range(3)] == ["blank", "blank", "comment"]
    assert c[3] == "parse_error"
    assert [c[i] for i in (4, 5, 6, 7)] == ["record"] * 4       # valid JSON, not an object
    assert [c[i] for i in (8, 9, 10, 11, 12)] == ["parse_error"] * 5
    assert c[13] == "record" and c[14] == "record"


def test_more_line_kinds(spark):
    lines = ['{"a": 1},{"b": 2}', "{}", '{"a": [1, 2], "b": {"c": 1}}', '{"a": 1', "[1] x", "1, 2", "{ }",
             '{"timestamp": "2025-01-01T00:00:00", "engine_id": "TRE-001", "engine_id": "TRE-002"}']
    c = {r["_ord"]: (r["kind"], r["doc"]) for r in ingest.classify_lines(lines_df(spark, lines)).collect()}
    assert c[0][0] == "parse_error"
    assert c[1] == ("record", {})
    assert c[2][0] == "record" and c[2][1]["a"] == "[1,2]"
    assert c[3][0] == "parse_error" and c[4][0] == "parse_error" and c[5][0] == "parse_error"
    assert c[6] == ("record", {})
    assert c[7][1]["engine_id"] == "TRE-002"          # duplicate key: the last one wins


def test_validation_rules(spark):
    lines = [
        obj(0, engine_id=...),                      # 0 missing engine_id -> dropped
        obj(1, engine_id=None),                     # 1 engine_id null -> kept (key present)
        obj(2, timestamp="yesterday"),              # 2 bad timestamp
        obj(3, chamber_pressure=None),              # 3 pressure null -> dropped
        obj(4, chamber_pressure=...),               # 4 no pressure key -> kept
        obj(5, fuel_flow="12.5"),                   # 5 numeric string -> kept
        obj(6, fuel_flow="abc"),                    # 6 bad number -> dropped
        obj(7, chamber_pressure=-42.5),             # 7 corrected to 42.5
        obj(8, fuel_flow=0),                        # 8 corrected to 0.1
        obj(9, fuel_flow=-3),                       # 9 untouched, not corrected
        obj(10, chamber_pressure=-1, fuel_flow=0),  # 10 corrected once
        obj(11, temperature=-273.15),               # 11 kept
        obj(12, temperature=-273.16),               # 12 dropped
        obj(13, chamber_pressure=-1, temperature=-300),  # 13 dropped, not corrected
        obj(14, temperature=6001),                  # 14 kept (warning only)
        "[1]", "5", "null",                         # 15-17 dropped (no keys)
        obj(18, timestamp=5),                       # 18 bad timestamp type -> dropped
        obj(19, timestamp="2025-01-01T00:00:09Z"),  # 19 Z accepted
        obj(20, timestamp="2025-06"),               # 20 partial date rejected
        obj(21, timestamp="2025-01-01 10:00:00+02:00"),  # 21 offset accepted
        obj(22, fuel_flow=True),                    # 22 boolean rejected (decision)
        obj(23, fuel_flow="1_000"),                 # 23 underscore rejected (decision)
        obj(24, fuel_flow=" 7.5 "),                 # 24 padded number accepted
    ]
    _, r = run(spark, lines)
    st = {i: r[i]["_status"] for i in r}
    assert st[0] == "missing_required"
    assert st[1] is None and r[1]["engine_id"] is None
    assert st[2] == "bad_timestamp"
    assert st[3] == "bad_numeric_chamber_pressure"
    assert st[4] is None and r[4]["chamber_pressure"] is None
    assert st[5] is None and r[5]["fuel_flow"] == "12.5"
    assert st[6] == "bad_numeric_fuel_flow"
    assert st[7] is None and float(r[7]["chamber_pressure"]) == 42.5 and r[7]["_corrected"]
    assert st[8] is None and r[8]["fuel_flow"] == "0.1" and r[8]["_corrected"]
    assert st[9] is None and float(r[9]["fuel_flow"]) == -3 and not r[9]["_corrected"]
    assert st[10] is None and r[10]["_corrected"]
    assert st[11] is None
    assert st[12] == "below_absolute_zero"
    assert st[13] == "below_absolute_zero" and not r[13]["_corrected"]
    assert st[14] is None
    assert st[15] == st[16] == st[17] == "missing_required"
    assert st[18] == "bad_timestamp"
    assert st[19] is None
    assert st[20] == "bad_timestamp"
    assert st[21] is None
    assert st[22] == "bad_numeric_fuel_flow"
    assert st[23] == "bad_numeric_fuel_flow"
    assert st[24] is None


def test_dedup_keeps_first_in_input_order(spark):
    a = obj(0, chamber_pressure=201.0)
    b = obj(0, chamber_pressure=999.0)      # same key, other measures
    bad_first = obj(1, fuel_flow="abc")     # invalid first copy: the valid later one wins
    good_later = obj(1, chamber_pressure=150.0)
    z = obj(2, timestamp="2025-01-01T00:00:02Z")
    plus = obj(2, timestamp="2025-01-01T00:00:02+00:00")  # same instant, other text: both kept
    lines = [a, bad_first, b, a, good_later, z, plus]
    clean = ingest.clean_lines(lines_df(spark, lines)).collect()
    by_ts = {(r["timestamp"], r["engine_id"]): r for r in clean}
    assert len(clean) == 4
    assert float(by_ts[(TS.format(0), "TRE-001")]["chamber_pressure"]) == 201.0
    assert float(by_ts[(TS.format(1), "TRE-002")]["chamber_pressure"]) == 150.0


def test_dedup_is_partition_invariant(spark):
    lines = [obj(i % 7, chamber_pressure=float(i)) for i in range(200)]
    df = lines_df(spark, lines)
    results = []
    for n in (1, 4, 32):
        out = ingest.clean_lines(df.repartition(n)).collect()
        results.append(sorted((r["timestamp"], r["engine_id"], r["chamber_pressure"]) for r in out))
    assert results[0] == results[1] == results[2]
    assert [float(x[2]) for x in results[0]] == [float(i) for i in range(7)]


def test_summary_invariants(spark):
    lines = ["", "# c", "{bad", obj(0), obj(0), obj(1, chamber_pressure=-5), obj(2, engine_id=...),
             obj(3, fuel_flow=0), obj(4, temperature=-400)]
    s = ingest.summary_from_lines(lines_df(spark, lines)).collect()[0]
    assert s["parsing_errors"] == 1
    assert s["total_records"] == 6
    assert s["valid_records"] == 4
    assert s["dropped_records"] == 2
    assert s["total_records"] == s["valid_records"] + s["dropped_records"]
    assert s["corrected_records"] == 2
    assert s["duplicate_records"] == 1
    assert float(s["success_rate_percent"]) == 66.7
    assert float(s["output_rate_percent"]) == 50.0


def test_summary_empty(spark):
    s = ingest.summary_from_lines(lines_df(spark, ["", "# only comments"])).collect()[0]
    assert s["total_records"] == 0 and s["success_rate_percent"] is None


def test_audit_order_and_stop_at_drop(spark):
    lines = [obj(0, chamber_pressure=-1, fuel_flow=0, temperature=-300), obj(1, temperature=7000), "{x",
             obj(2), obj(2)]
    a = ingest.audit(lines_df(spark, lines)).orderBy("_ord", "step").collect()
    ev = [(r["_ord"], r["rule"]) for r in a]
    assert (0, "negative_pressure_corrected") in ev and (0, "zero_fuel_corrected") in ev
    assert (0, "below_absolute_zero") in ev
    assert (1, "high_temperature_warning") in ev
    assert (2, "parse_error") in ev
    assert (4, "duplicate_removed") in ev and (3, "duplicate_removed") not in ev


def test_jsonl_file_scan_and_csv_roundtrip(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        f.write("\n".join([obj(0), "", obj(1, chamber_pressure=-3), obj(0, chamber_pressure=1.0)]) + "\n")
    with open(os.path.join(src, "b.jsonl"), "w") as f:
        f.write("\n".join(["# header", obj(2, engine_id=" tre-099 "), obj(3, fuel_flow=...)]) + "\n")
    lines = read_jsonl(spark, src)
    clean = ingest.clean_lines(lines)
    out = os.path.join(tmp_dir, "csv")
    write_clean_csv(clean, out)
    back = read_clean_csv(spark, out)
    rows = {(r["timestamp"], r["engine_id"]): r for r in back.collect()}
    assert len(rows) == 4
    assert float(rows[(TS.format(0), "TRE-001")]["chamber_pressure"]) == 200.0   # first in file order
    assert float(rows[(TS.format(1), "TRE-002")]["chamber_pressure"]) == 3.0
    assert (TS.format(2), " tre-099 ") in rows                                   # kept byte for byte
    assert rows[(TS.format(3), "TRE-004")]["fuel_flow"] is None                  # empty cell -> NULL
    raw = raw_load(back, "2025-02-01T00:00:00").collect()
    assert len({r["_airbyte_raw_id"] for r in raw}) == 4


def test_drop_reasons_are_exclusive(spark):
    lines = [obj(0, engine_id=..., fuel_flow="x"), obj(1, timestamp="bad", chamber_pressure=None)]
    r = {x["_ord"]: x["reason"] for x in ingest.drop_reasons(lines_df(spark, lines)).collect()}
    assert r == {0: "missing_required", 1: "bad_timestamp"}


def test_no_filter_below_dedup(spark):
    """The validity test must not be duplicated under the aggregate (see dedup_first)."""
    df = lines_df(spark, [obj(0)])
    plan = ingest.clean_lines(df)._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Aggregate")[-1]
    assert "Filter" not in below
    assert F is not None


def test_input_order_survives_file_splits(spark, tmp_dir):
    """A file read as many splits (and two files): the first copy in file order still wins."""
    src = os.path.join(tmp_dir, "split")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        for i in range(3000):                       # keys repeat every 100 lines; first copy = i < 100
            f.write(obj(i % 10, engine_id=f"E{i % 100:03d}", chamber_pressure=float(i)) + "\n")
    with open(os.path.join(src, "b.jsonl"), "w") as f:
        for i in range(100):                        # later file: never wins
            f.write(obj(i % 10, engine_id=f"E{i:03d}", chamber_pressure=-1.0) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = read_jsonl(spark, src)
        assert lines.rdd.getNumPartitions() > 10
        out = {r["engine_id"]: float(r["chamber_pressure"]) for r in ingest.clean_lines(lines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(out) == 100
    assert out == {f"E{i:03d}": float(i) for i in range(100)}


def test_observed_summary_equals_aggregate_summary(spark, tmp_dir):
    lines = ["", "# c", "{bad", obj(0), obj(0), obj(1, chamber_pressure=-5), obj(2, engine_id=...),
             obj(3, fuel_flow=0), obj(4, temperature=-400), obj(5)]
    df = lines_df(spark, lines)
    out, before, after = ingest.observed_clean(df)
    write_clean_csv(out, os.path.join(tmp_dir, "obs_csv"))          # the one action
    observed = ingest.summary_from_observations(before, after)
    agg = ingest.summary_from_lines(df).collect()[0].asDict()
    assert observed == agg


def test_crlf_lines_and_csv_quoting(spark, tmp_dir):
    src = os.path.join(tmp_dir, "crlf")
    os.makedirs(src)
    with open(os.path.join(src, "w.jsonl"), "w", newline="") as f:
        f.write(obj(0) + "\r\n" + obj(1, engine_id='TRE, "001"') + "\r\n\r\n" + obj(2) + "\r\n")
    clean = ingest.clean_lines(read_jsonl(spark, src))
    out = os.path.join(tmp_dir, "q_csv")
    write_clean_csv(clean, out)
    back = {r["engine_id"]: r for r in read_clean_csv(spark, out).collect()}
    assert set(back) == {"TRE-001", 'TRE, "001"', "TRE-003"}
    assert float(back['TRE, "001"']["chamber_pressure"]) == 200.0


def test_diagnostics_parse_each_line_once(spark):
    """Rows picked by a derived condition come from a generator, so no filter copies the parse."""
    df = lines_df(spark, [obj(0), obj(0), "{bad", obj(1, fuel_flow="x")])

    def parses(d):
        return d._jdf.queryExecution().optimizedPlan().toString().count("from_json")

    assert parses(ingest.clean_lines(df)) == 1
    assert parses(ingest.summary_from_lines(df)) == 1
    assert parses(ingest.drop_reasons(df).where(F.col("reason") == "bad_timestamp")) == 1
    assert parses(ingest.audit(df)) <= 3
    assert sorted(r["reason"] for r in ingest.drop_reasons(df).collect()) == ["bad_numeric_fuel_flow"]


def test_one_parse_gives_what_separate_parses_give(spark, tmp_dir):
    """Cleaner, audit log, statistics and rejects from one landed parse; every rule, NULL keys and repeats included."""
    lines = ["", "# c", "{bad", "5", "[1]", "{} {}", obj(0), obj(0), obj(0, temperature=9), obj(1, engine_id=None), obj(1, engine_id=None),
             obj(2, timestamp="x"), obj(3, engine_id=...), obj(4, chamber_pressure="x"), obj(5, chamber_pressure=-3, fuel_flow="x"),
             obj(6, chamber_pressure=-3, fuel_flow=0, temperature=7000), obj(7, temperature="x", fuel_flow=0),
             obj(8, temperature=-300), obj(9, chamber_pressure=None), obj(9, fuel_flow=...)]
    df = lines_df(spark, lines)
    out = ingest.land_outputs(df, os.path.join(tmp_dir, "o"))

    def rows(d):
        return sorted(map(repr, map(tuple, d.select(*sorted(d.columns)).collect())))

    assert rows(out.clean()) == rows(ingest.clean_lines(df))
    assert rows(out.audit()) == rows(ingest.audit(df))
    assert rows(out.summary()) == rows(ingest.summary_from_lines(df))
    assert rows(out.drop_reasons()) == rows(ingest.drop_reasons(df))
    assert {r["record"] for r in out.dropped().collect()} <= set(lines)
    assert [r["_ord"] for r in out.parse_errors().orderBy("_ord").collect()] == [2, 5]

    def parses(d):
        return d._jdf.queryExecution().optimizedPlan().toString().count("from_json")

    assert parses(ingest.classified_rows(df)) == 1
    assert [parses(d) for d in (out.clean(), out.audit(), out.summary(), out.drop_reasons())] == [0] * 4


def test_one_parse_of_nothing_and_of_files(spark, tmp_dir):
    empty = ingest.land_outputs(lines_df(spark, [""]).limit(0), os.path.join(tmp_dir, "e"))
    assert empty.clean().count() == empty.audit().count() == 0
    assert empty.summary().first()["total_records"] == 0
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for name in "ab":
        with open(os.path.join(src, f"{name}.jsonl"), "w") as f:
            f.write("\n".join([obj(0, temperature=1 + ord(name)), "{bad", obj(1)]) + "\n")
    lines = read_jsonl(spark, src)
    out = ingest.land_outputs(lines, os.path.join(tmp_dir, "f"))
    assert sorted(out.clean().collect()) == sorted(ingest.clean_lines(lines).collect())
    assert out.audit().groupBy("rule").count().orderBy("rule").collect() == ingest.audit(lines).groupBy("rule").count().orderBy("rule").collect()
