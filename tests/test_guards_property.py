"""Property tests: the cleaner's number and timestamp guards vs Python's own parsing.

Python's ``float`` and ``datetime.fromisoformat`` define what the source cleaner
accepts. Our guards must agree with them on every string they both can see,
apart from the documented decisions (no underscores, booleans, NaN/inf).
"""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plume.functions.columns import iso_timestamp_text, measure_text_value

digits = st.text(alphabet="0123456789", min_size=0, max_size=6)
number_like = st.builds(
    lambda pad1, sign, a, dot, b, exp, pad2: f"{pad1}{sign}{a}{dot}{b}{exp}{pad2}",
    st.sampled_from(["", " ", "\t", " \n"]), st.sampled_from(["", "+", "-"]), digits, st.sampled_from(["", "."]),
    digits, st.sampled_from(["", "e5", "E-2", "e", "e+", "x"]), st.sampled_from(["", " ", "\t"]))


def _python_float(s):
    try:
        v = float(s)
    except ValueError:
        return None
    if "_" in s or math.isnan(v) or math.isinf(v):
        return None
    return v


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(number_like, min_size=300, max_size=300))
def test_numbers_agree_with_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", measure_text_value(F.col("t")).alias("v")).collect()}
    for t in texts:
        assert got[t] == _python_float(t), t


two = st.integers(0, 61).map(lambda i: f"{i:02d}")
day_like = st.one_of(
    st.builds(lambda y, m, d: f"{y}-{m}-{d}", st.sampled_from(["2024", "2025", "1999", "0000", "9999"]), two, two),
    st.builds(lambda m, d: f"2024{m}{d}", two, two),
    st.builds(lambda w, d: f"2024-W{w}{d}", two, st.sampled_from(["", "-1", "-7", "-8", "-0"])),
    st.builds(lambda w, d: f"2026W{w}{d}", two, st.sampled_from(["", "1", "7", "9"])))
time_like = st.one_of(
    two, st.builds(lambda h, m: f"{h}:{m}", two, two), st.builds(lambda h, m, s: f"{h}:{m}:{s}", two, two, two),
    st.builds(lambda h, m: f"{h}{m}", two, two), st.builds(lambda h, m, s: f"{h}{m}{s}", two, two, two))
ts_like = st.builds(
    lambda day, rest: day + rest, day_like,
    st.one_of(st.just(""), st.builds(
        lambda sep, t, frac, tz: sep + t + frac + tz, st.sampled_from(["T", " ", "x", "é", "_"]), time_like,
        st.sampled_from(["", "", ".1", ".123456", ".123456789", ",5", ".", ".1a"]),
        st.sampled_from(["", "", "Z", "+00:00", "-05:30", "+0000", "-2359", "+05", "+24:00", "+99:99", "-00:60", "+5:30",
                         "+05:30:15", "+053015", "+05:30:15.25", "z", "ZZ"]))))


def _python_ts(s):
    try:
        v = dt.datetime.fromisoformat(s.replace("Z", "+00:00"))
    except ValueError:
        return None
    return v.replace(tzinfo=None)          # wall clock kept, offset dropped


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ts_like, min_size=300, max_size=300))
def test_timestamps_agree_with_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", iso_timestamp_text(F.col("t")).alias("v")).collect()}
    for t in texts:
        assert got[t] == _python_ts(t), t


def test_decided_rejections(spark):
    cases = ["1_000", "True", "nan", "inf", "-Infinity", "1d", "0x10"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert all(r[0] is None for r in df.select(measure_text_value(F.col("t"))).collect())
    ts = ["2025", "2025-06", "2025-6-3", " 2025-01-01", "10:00", "2025-01-01T", "2025-01-01T10:00\n", "2025-01-01\n"]
    df = spark.createDataFrame([(c,) for c in ts], "t string")
    assert all(r[0] is None for r in df.select(iso_timestamp_text(F.col("t"))).collect())


def test_everyday_forms_are_kept(spark):
    ts = ["2025-01-01T10", "2025-01-01T10:00:00+0000", "2025-01-01T10:00:00.123456789", "2025-01-01T10:00:00,5", "20250101T100000",
          "2025-01-01X10:00", "2025-W01-1T10:00", "2025-01-01T10:00:00+23:59"]
    rows = spark.createDataFrame([(c,) for c in ts], "t string").select("t", iso_timestamp_text(F.col("t")).alias("v")).collect()
    assert {r["t"]: r["v"] for r in rows} == {t: _python_ts(t) for t in ts}
    assert all(r["v"] is not None for r in rows)
