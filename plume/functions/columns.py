"""Scalar functions of the pipeline, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plume import rules

# A timestamp text accepted by the cleaner is what Python's ``datetime.fromisoformat`` takes
# (with every ``Z`` read as ``+00:00``). Nearly all texts have the plain form; Spark's own cast
# reads it, guarded by this pattern because that cast is looser (``2025``, ``2025-6-3``).
ISO_TIMESTAMP_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)?)?\z"
)
# The other forms: compact and week dates, any one-character separator, compact times, a
# fraction of any length after any time field, and offsets down to fractions of a second.
ISO_OTHER_PATTERN = (
    r"(?s)^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})|(\d{4})(?:-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?))"
    r"(?:.(?:(\d{2})(?::(\d{2})(?::(\d{2}))?)?|(\d{2})(\d{2})(\d{2})?)"
    r"(?:[.,](\d+)|[.,](?=[+-])| (?=[+-]))?"
    r"(?:([+-])(\d{2})(?::(\d{2})(?::(\d{2}))?|(\d{2})(\d{2})?)?(?:[.,]\d*)?)?)?\z"
)
# year month day, week year week weekday, hour minute second fraction, offset hour minute second
_ISO_FIELDS = "$1$4|$2$5|$3$6|$7|$8$10|$9$11|$12$15|$13$16|$14$17|$18|$20|$21$23|$22$24"
# A number text accepted by the cleaner (decimal or exponent form, optional sign,
# surrounding blanks allowed). Underscores, booleans, NaN and infinities are not.
NUMERIC_PATTERN = r"^[ \t\n\r\f\x0B]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[ \t\n\r\f\x0B]*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a ``datetime`` or ISO text.

    Built from text, so it means the same wall clock whatever the session time
    zone (a Python ``datetime`` literal would pass through the session zone).
    """
    import datetime as _dt

    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def iso_timestamp_text(text) -> Column:
    """Parsed wall-clock ``timestamp_ntz`` of an ISO text, NULL when invalid.

    ``Z`` is read as ``+00:00``; any offset (below a day) is dropped and the wall clock kept;
    fractions are cut after microseconds.
    """
    t = _col(text)
    plain = F.regexp_replace(t, r"(Z|[+-]\d{2}:\d{2})$", "").try_cast("timestamp_ntz")
    full = F.regexp_replace(t, "Z", "+00:00")
    return (F.when(t.rlike(ISO_TIMESTAMP_PATTERN), F.when(~t.startswith("0000"), plain))
            # the lambda names the fields once: their many uses stay out of the generated code
            .when(full.rlike(ISO_OTHER_PATTERN), F.get(F.transform(F.array(
                F.split(F.regexp_replace(full, ISO_OTHER_PATTERN, _ISO_FIELDS), r"\|")), _iso_fields_time), 0)))


def _iso_fields_time(parts: Column) -> Column:
    text = lambda i: parts.getItem(i)
    number = lambda i: F.coalesce(text(i).try_cast("int"), F.lit(0))
    day = F.when(text(0) != "0000", F.concat_ws("-", text(0), text(1), text(2)).try_cast("date"))
    # week 1 holds the 4th of January
    fourth = F.concat(text(3), F.lit("-01-04")).try_cast("date")
    weekday = F.when(text(5) == "", 1).otherwise(number(5))
    of_week = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (number(4) - 1) * 7 + weekday - 1)
    of_week = F.when(number(4).between(1, 53) & weekday.between(1, 7) & (text(3) != "0000")
                     & (F.extract(F.lit("YEAROFWEEK"), of_week) == number(3)), of_week)
    date = F.when(text(0) != "", day).otherwise(of_week)
    valid = ((number(6) < 24) & (number(7) < 60) & (number(8) < 60)
             & (number(10) * 3600 + number(11) * 60 + number(12) < 86400))
    clock = F.format_string("%s %02d:%02d:%02d.%s", date.cast("string"), number(6), number(7), number(8),
                            F.rpad(F.substring(text(9), 1, 6), 6, "0"))
    return F.when(valid & date.isNotNull(), clock.try_cast("timestamp_ntz"))


def numeric_text(text) -> Column:
    """True when ``text`` is a finite number the cleaner accepts."""
    return _col(text).rlike(NUMERIC_PATTERN)


_WHITESPACE = " \t\n\r\f\u000b"


def measure_text_value(text) -> Column:
    """The double value of a measure text, NULL when it is not a finite number."""
    t = _col(text)
    v = F.btrim(t, F.lit(_WHITESPACE)).try_cast("double")
    return F.when(numeric_text(t) & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def to_double(c) -> Column:
    return _col(c).cast("double")


def between(c, lo, hi) -> Column:
    c = _col(c)
    return (c >= F.lit(lo)) & (c <= F.lit(hi))


def fuel_efficiency_ratio(fuel, pressure) -> Column:
    """fuel / pressure when pressure > 0, else NULL (double arithmetic)."""
    p = _col(pressure)
    return F.when(p > 0, to_double(fuel) / to_double(p))


def performance_score(pressure, fuel, temperature) -> Column:
    """100 x weighted in-band indicators; exact decimal (values 0..100)."""
    parts = []
    for c, (lo, hi, weight) in ((pressure, rules.PRESSURE_SCORE_BAND),
                                (fuel, rules.FUEL_SCORE_BAND),
                                (temperature, rules.TEMPERATURE_SCORE_BAND)):
        parts.append(F.when(between(c, lo, hi), F.lit(weight).cast("decimal(2,1)"))
                     .otherwise(F.lit("0.0").cast("decimal(2,1)")))
    return ((parts[0] + parts[1] + parts[2]) * F.lit(100)).cast("decimal(5,1)")


def _outside(c, bounds) -> Column:
    c = _col(c)
    return (c < F.lit(bounds[0])) | (c > F.lit(bounds[1]))


def is_anomaly(pressure, fuel, temperature) -> Column:
    """Any measure strictly outside its anomaly bounds."""
    return F.coalesce(
        _outside(pressure, rules.PRESSURE_ANOMALY)
        | _outside(fuel, rules.FUEL_ANOMALY)
        | _outside(temperature, rules.TEMPERATURE_ANOMALY),
        F.lit(False),
    )


def anomaly_type(pressure, fuel, temperature) -> Column:
    """First failing bound in the fixed order, else NULL."""
    p, f, t = _col(pressure), _col(fuel), _col(temperature)
    low, high = "LOW_", "HIGH_"
    checks = (
        (p < rules.PRESSURE_ANOMALY[0], low + "PRESSURE"),
        (p > rules.PRESSURE_ANOMALY[1], high + "PRESSURE"),
        (f < rules.FUEL_ANOMALY[0], low + "FUEL_FLOW"),
        (f > rules.FUEL_ANOMALY[1], high + "FUEL_FLOW"),
        (t < rules.TEMPERATURE_ANOMALY[0], low + "TEMPERATURE"),
        (t > rules.TEMPERATURE_ANOMALY[1], high + "TEMPERATURE"),
    )
    out = None
    for cond, label in checks:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def reading_health(score) -> Column:
    s = _col(score)
    out = None
    for threshold, label in rules.READING_HEALTH:
        out = F.when(s >= threshold, label) if out is None else out.when(s >= threshold, label)
    return out.otherwise(rules.READING_HEALTH_ELSE)


def engine_health(rate) -> Column:
    r = _col(rate)
    out = None
    for threshold, label in rules.ENGINE_HEALTH:
        out = F.when(r <= threshold, label) if out is None else out.when(r <= threshold, label)
    return out.otherwise(rules.ENGINE_HEALTH_ELSE)


def score_band(score) -> Column:
    s = _col(score)
    out = None
    for threshold, label in rules.SCORE_BAND:
        out = F.when(s >= threshold, label) if out is None else out.when(s >= threshold, label)
    return out.otherwise(rules.SCORE_BAND_ELSE)


def time_key(ts) -> Column:
    """YYYYMMDDHH as BIGINT."""
    t = _col(ts)
    return (F.year(t).cast("bigint") * 1000000 + F.month(t) * 10000
            + F.dayofmonth(t) * 100 + F.hour(t)).cast("bigint")


def day_of_week_sun0(ts) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark's ``dayofweek`` is 1..7)."""
    return (F.dayofweek(_col(ts)) - 1).cast("int")


def ratio_half_up(numer, denom, scale: int, precision: int) -> Column:
    """``numer / denom`` rounded half-up (away from zero) at ``scale`` places, exactly.

    Both are whole numbers of up to 38 digits (``denom`` positive); the quotient is taken in
    integers, so nothing is rounded twice and no count is too large. NULL when ``denom`` is 0.
    """
    n, d = _col(numer).cast("decimal(38,0)"), _col(denom).cast("decimal(38,0)")
    step = F.lit(2 * 10 ** scale).cast("decimal(12,0)")
    units = F.call_function("div", F.abs(n) * step + d, d * F.lit(2))
    value = (F.signum(n).cast("int") * units).cast("decimal(19,0)") * F.lit(f"{1 / 10 ** scale:.{scale}f}").cast(
        f"decimal({scale + 1},{scale})")
    return F.when(d > 0, value).cast(f"decimal({precision},{scale})")


def exact_avg(total, count, scale: int = 7, precision: int = 12, places: int = 3) -> Column:
    """``total / count`` rounded half-up at ``scale`` places, for a decimal ``total`` of ``places`` places."""
    unit = 10 ** places
    whole = (_col(total).cast(f"decimal(38,{places})") * F.lit(unit)).cast("decimal(38,0)")
    return ratio_half_up(whole, _col(count).cast("decimal(30,0)") * F.lit(unit), scale, precision)


def wide_sum(c, places: int = 3) -> Column:
    """Sum of a decimal measure in 38 digits: no number of readings overflows it."""
    return F.sum(_col(c).cast(f"decimal(28,{places})"))


def pct_half_up(numer, denom, scale: int = 2) -> Column:
    """ROUND(numer * 100.0 / denom, scale) in exact integer arithmetic, half-up."""
    return ratio_half_up(_col(numer).cast("decimal(30,0)") * F.lit(100), denom, scale, 8 + scale)
