"""Reusable data-quality checks. Each check returns the failing rows.

``run_declared_tests`` evaluates the declared test suite over the models. All
row-level tests of one model (not-null, accepted-values) share one aggregate pass;
each uniqueness test is one grouped aggregate whose partial aggregation keeps a
hot key cheap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume import rules


# ------------------------------------------------------------------ single checks

def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` occurring more than once (NULLs ignored), with counts."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
            .where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose value is not in ``values`` (NULL passes, as SQL ``NOT IN`` does)."""
    return df.where(~F.col(column).isin(*values))


def unique_combination(df: DataFrame, columns) -> DataFrame:
    """Combinations of ``columns`` occurring more than once, with counts."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
            .where(F.col("n_records") > 1))


def fact_grain(fact: DataFrame, column: str = "airbyte_raw_id") -> DataFrame:
    """``airbyte_raw_id`` values with more than one fact row."""
    return (fact.groupBy(column).agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
            .where(F.col("n_records") > 1))


# ------------------------------------------------------------------ declared suite

@dataclass(frozen=True)
class Test:
    model: str
    kind: str           # not_null | unique | accepted_values | unique_combination | grain
    column: str         # column, or comma-joined columns
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.model}:{self.column}"


def _nn(model, *cols):
    return [Test(model, "not_null", c) for c in cols]


DECLARED_TESTS = (
    # source
    *_nn("raw", "_airbyte_raw_id", "_airbyte_extracted_at", "engine_id", "timestamp"),
    Test("raw", "unique", "_airbyte_raw_id"),
    # staging
    Test("staging", "unique", "_airbyte_raw_id"),
    *_nn("staging", "_airbyte_raw_id", "engine_id", "reading_timestamp", "chamber_pressure_psi",
         "fuel_flow_kg_per_sec", "temperature_fahrenheit", "is_anomaly"),
    # fact
    Test("fact", "unique", "reading_key"),
    *_nn("fact", "reading_key", "engine_key", "pressure_metric_key", "fuel_flow_metric_key",
         "temperature_metric_key", "time_key", "airbyte_raw_id", "chamber_pressure_psi",
         "fuel_flow_kg_per_sec", "temperature_fahrenheit", "is_anomaly", "is_out_of_normal_range"),
    Test("fact", "accepted_values", "is_out_of_normal_range", (True, False)),
    # engine mart
    Test("engine_summary", "unique_combination", "engine_id"),
    Test("engine_summary", "unique", "engine_id"),
    *_nn("engine_summary", "engine_id", "engine_name", "total_readings", "anomaly_rate_percent",
         "health_status"),
    Test("engine_summary", "accepted_values", "health_status", rules.ENGINE_HEALTH_VALUES),
    *_nn("engine_summary", "performance_rank"),
    # daily mart
    Test("daily_trends", "unique_combination", "date_actual"),
    Test("daily_trends", "unique", "date_actual"),
    *_nn("daily_trends", "date_actual", "total_readings", "daily_anomaly_rate_percent"),
    Test("daily_trends", "accepted_values", "anomaly_trend", rules.TREND_VALUES),
    Test("daily_trends", "accepted_values", "performance_trend", rules.TREND_VALUES),
    *_nn("daily_trends", "active_engines"),
    # custom grain test
    Test("fact", "grain", "airbyte_raw_id"),
)


MODELS = ("raw", "staging", "fact", "engine_summary", "daily_trends")

#: The declared kinds on inputs that break them (records before cleaning and deduplication).
DIRTY_TESTS = (
    *_nn("raw", "_airbyte_raw_id", "engine_id", "timestamp"),
    Test("raw", "unique", "_airbyte_raw_id"),
    Test("staging", "unique", "_airbyte_raw_id"),
    Test("staging", "unique_combination", "engine_id,reading_timestamp"),
    Test("staging", "accepted_values", "engine_id", tuple(e for e, _ in rules.ENGINE_NAMES)),
    *_nn("staging", "anomaly_type"),
    Test("staging", "grain", "_airbyte_raw_id"),
)


def _row_level_failures(df: DataFrame, tests) -> DataFrame:
    """One aggregate pass over ``df`` counting failures of all row-level tests."""
    aggs = []
    for i, t in enumerate(tests):
        if t.kind == "not_null":
            cond = F.col(t.column).isNull()
        else:
            cond = ~F.col(t.column).isin(*t.values)
        aggs.append(F.count_if(cond).cast("bigint").alias(f"t{i}"))
    row = df.agg(*aggs)
    stack = ", ".join(f"'{t.name}', t{i}" for i, t in enumerate(tests))
    return row.selectExpr(f"stack({len(tests)}, {stack}) AS (test_name, failures)")


def _group_failures(df: DataFrame, t: Test) -> DataFrame:
    if t.kind == "unique":
        failing = unique(df, t.column)
    elif t.kind == "grain":
        failing = fact_grain(df, t.column)
    else:
        failing = unique_combination(df, t.column.split(","))
    return failing.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(t.name).alias("test_name"), "failures")


def run_declared_tests(models: dict, tests=DECLARED_TESTS) -> DataFrame:
    """``(test_name, model, test_kind, column_name, failures, status)`` per declared test.

    ``models`` maps model names (``raw``, ``staging``, ``fact``, ``engine_summary``,
    ``daily_trends``) to DataFrames; tests of absent models are skipped.
    """
    parts = []
    for model, df in models.items():
        mine = [t for t in tests if t.model == model]
        row_tests = [t for t in mine if t.kind in ("not_null", "accepted_values")]
        if row_tests:
            parts.append(_row_level_failures(df, row_tests))
        parts += [_group_failures(df, t) for t in mine if t.kind not in ("not_null", "accepted_values")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    meta = F.split("test_name", ":")
    return out.select(
        "test_name",
        meta.getItem(1).alias("model"),
        meta.getItem(0).alias("test_kind"),
        meta.getItem(2).alias("column_name"),
        "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


def store_failures(failing: DataFrame, path: str) -> None:
    """Keep the failing rows of a check as a table (parquet) for inspection."""
    failing.write.mode("overwrite").parquet(path)


def failing_rows(df: DataFrame, t: Test) -> DataFrame:
    """The rows (or duplicated keys, with counts) that fail test ``t`` on ``df``."""
    if t.kind == "not_null":
        return not_null(df, t.column)
    if t.kind == "accepted_values":
        return accepted_values(df, t.column, t.values)
    if t.kind == "unique":
        return unique(df, t.column)
    if t.kind == "grain":
        return fact_grain(df, t.column)
    return unique_combination(df, t.column.split(","))


def row_failures(df: DataFrame, model: str, tests=DECLARED_TESTS) -> DataFrame:
    """The rows of ``df`` that break row-level tests of ``model``, once per broken test, which
    ``test_name`` names. One pass for all tests."""
    broken = [F.when(F.col(t.column).isNull() if t.kind == "not_null" else ~F.col(t.column).isin(*t.values), t.name)
              for t in tests if t.model == model and t.kind in ("not_null", "accepted_values")]
    return df.withColumn("test_name", F.explode(F.filter(F.array(*broken), lambda x: x.isNotNull())))


def stored_failures(spark, paths: dict, tests) -> DataFrame:
    """The stored failing rows of ``tests`` as ``test_name, failing, n_records``: the offending
    value (the row id for NULLs) and, for duplicates, how often it occurs."""
    parts = []
    for t in tests:
        df = spark.read.parquet(paths[t.name])
        if t.kind in ("not_null", "accepted_values"):
            shown = F.col("_airbyte_raw_id") if t.kind == "not_null" else F.col(t.column)
            counted = F.lit(1)
        else:
            shown = F.concat_ws("|", *[F.col(c).cast("string") for c in t.column.split(",")])
            counted = F.col("n_records")
        parts.append(df.select(F.lit(t.name).alias("test_name"), shown.cast("string").alias("failing"),
                               counted.cast("bigint").alias("n_records")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def store_test_failures(models: dict, base: str, tests=DECLARED_TESTS) -> dict:
    """Write the failing rows of every declared test under ``base/<test>``.

    Returns ``{test name: path}``. Each test writes its own (usually empty)
    table, like a warehouse keeping one failures table per test.
    """
    paths = {}
    for t in tests:
        if t.model not in models:
            continue
        path = f"{base.rstrip('/')}/{t.name.replace(':', '__').replace(',', '_')}"
        store_failures(failing_rows(models[t.model], t), path)
        paths[t.name] = path
    return paths
