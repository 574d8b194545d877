"""Sums and counts far beyond the test data, through the expressions that the models use."""

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from plume.functions.columns import exact_avg, pct_half_up, ratio_half_up, wide_sum
from plume.operators import marts, serving
from plume.sources import fixtures


def half_up(num, den, places):
    from decimal import localcontext
    with localcontext() as c:
        c.prec = 80
        return (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def test_averages_and_rates_are_exact_at_any_count(spark):
    cases = [("9999999999999999.999", 10 ** 12), ("1e16", 3 * 10 ** 12 + 1), ("-123456789012.345", 7), ("0.0005", 1000), ("15848880.162", 73445),
             ("2", 3), ("-0.0015", 30000), ("4000000000000000", 10 ** 12)]
    rows = spark.createDataFrame([(Decimal(s), n) for s, n in cases], "s decimal(38,4), n bigint")
    got = rows.select(exact_avg(F.col("s").cast("decimal(38,4)"), "n", 7, 30, 4)).collect()
    assert [r[0] for r in got] == [half_up(Decimal(s), n, 7) for s, n in cases]
    big = spark.createDataFrame([(10 ** 17 - 1, 3 * 10 ** 17), (1, 8), (1, 0)], "a bigint, n bigint")
    assert [r[0] for r in big.select(pct_half_up("a", "n")).collect()] == [
        half_up((10 ** 17 - 1) * 100, 3 * 10 ** 17, 2), Decimal("12.50"), None]
    assert spark.range(1).select(ratio_half_up(F.lit(-5), F.lit(2), 0, 10)).first()[0] == -3


def test_utilisation_is_rounded_once(spark):
    cases = [("15848880.162", 73445, 350), ("61.654999", 1, 100)]
    rows = spark.createDataFrame([(Decimal(s).quantize(Decimal("0.001")), n, k) for s, n, k in cases],
                                 "s decimal(38,3), n bigint, k int")
    got = [rows.where(F.col("n") == n).select(marts.utilisation(F.col("s"), F.col("n"), k)).first()[0] for _, n, k in cases]
    assert got == [half_up(Decimal(s).quantize(Decimal("0.001")) * 100, n * k, 2) for s, n, k in cases]
    assert got[0] == Decimal("61.65")


def test_sums_near_1e16_pass_through_the_models(spark):
    """Partial sums as they would arrive from many readings: no 18-digit sum, no 10-digit count."""
    s = spark.createDataFrame([(Decimal("9999999999999999.999"),)] * 20, "x decimal(19,3)").agg(wide_sum("x")).first()[0]
    assert s == 20 * Decimal("9999999999999999.999")
    rows = [(i, 1 + i % 3, "TRE-001", f"2025-01-01 00:00:{i % 60:02d}", Decimal("99999.999"), Decimal("99999.999"), Decimal("99999.999"))
            for i in range(300)]
    fact = spark.createDataFrame(rows, "airbyte_raw_id bigint, engine_key int, engine_id string, t string, chamber_pressure_psi decimal(8,3), "
                                       "fuel_flow_kg_per_sec decimal(8,3), temperature_fahrenheit decimal(8,3)").select(
        "*", F.col("t").cast("timestamp_ntz").alias("reading_timestamp"), F.lit(1.0).alias("fuel_efficiency_ratio"))
    engines, metrics = fixtures.dim_engines(spark), fixtures.dim_metrics(spark)
    q1 = serving.q1_engine_comparison(fact, engines)
    assert dict(q1.dtypes)["avg_pressure"] == "decimal(12,7)"
    assert {r.engine_id: (r.avg_pressure, r.total_readings) for r in q1.collect()} == {
        f"TRE-00{k}": (Decimal("99999.9990000"), 100) for k in (1, 2, 3)}
    plan = q1._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(28,3)" in plan and "decimal(10,0)" not in plan
    q3 = serving.q3_metric_matrix(fact, engines, metrics)
    assert {r.avg_pressure for r in q3.where("metric_category = 'PRESSURE'").collect()} == {Decimal("99999.9990000")}
