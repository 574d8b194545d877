"""A5: the models as SQL views: schemas, and totals that must agree between views."""

import pytest

from plume import schemas
from plume.plans.pipeline import Pipeline
from plume.plans.views import MODEL_VIEWS, register_pipeline
from tests.conftest import SF001


@pytest.fixture(scope="module")
def views(spark):
    return register_pipeline(Pipeline(spark, SF001))


def test_every_model_has_its_view_and_columns(spark, views):
    assert views == MODEL_VIEWS
    assert spark.table(views["fact"]).columns == list(schemas.FACT_COLUMNS)
    assert spark.table(views["staging"]).columns == list(schemas.STAGING_COLUMNS)
    assert [f.name for f in schemas.RAW_SCHEMA.fields] == spark.table(views["raw"]).columns


def test_totals_agree_between_views(spark, views):
    v = views
    total = spark.sql(f"SELECT count(*) AS n, count_if(is_anomaly) AS a FROM {v['fact']}").first()
    for mart, column in ((v["engine_summary"], "anomaly_count"), (v["daily_trends"], "total_anomalies")):
        assert tuple(spark.sql(f"SELECT sum(total_readings), sum({column}) FROM {mart}").first()) == tuple(total)
    assert spark.sql(f"SELECT count(*) FROM {v['staging']} ANTI JOIN {v['fact']} ON _airbyte_raw_id = airbyte_raw_id").first()[0] == 0
    worst = spark.sql(f"SELECT max(daily_anomaly_rate_percent) FROM {v['daily_trends']} WHERE worst_anomaly_day_rank = 1").first()[0]
    assert worst == spark.sql(f"SELECT max(daily_anomaly_rate_percent) FROM {v['daily_trends']}").first()[0]


def test_unknown_engines_drop_out_of_a_dimension_join(spark, views):
    v = views
    unknown = spark.sql(f"SELECT count(*) FROM {v['fact']} WHERE engine_key = -1").first()[0]
    joined = spark.sql(f"SELECT count(*) FROM {v['fact']} JOIN {v['engines']} USING (engine_key)").first()[0]
    assert unknown > 0 and joined + unknown == spark.table(v["fact"]).count()
    pairs = spark.sql(f"SELECT count(*), count(DISTINCT sensor_id) FROM {v['bridge']}").first()
    current = spark.sql(f"SELECT count(*) FROM {v['engines']} WHERE is_current").first()[0]
    assert tuple(pairs) == (current * spark.table(v["metrics"]).count(),) * 2
