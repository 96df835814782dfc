"""Properties of the pipeline on the driver tables."""

import pytest
from pyspark.sql import functions as F

from millstat.params import Params
from millstat.plans.registry import Frames

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, SF, Params(expected_per_day=8))


def test_staging_has_no_more_rows_than_raw(frames):
    assert frames.stg.count() <= frames.raw.count()


def test_staged_keys_are_unique(frames):
    assert frames.stg.groupBy("sensor_id").count().filter("count > 1").count() == 0


def test_energy_counts_every_valid_reading(frames):
    valid = frames.stg.filter(~F.col("is_out_of_range")).count()
    assert frames.energy.agg(F.sum("reading_count")).first()[0] == valid


def test_oee_components_in_range(frames):
    bad = frames.oee.filter(
        (F.col("oee_score") < 0) | (F.col("oee_score") > 100) | (F.col("availability_pct") > 100)
        | (F.col("performance_pct") > 100) | (F.col("quality_pct") < 0)).count()
    assert bad == 0


def test_one_forecast_per_unit(frames):
    units = frames.stg.select("equipment_id").distinct().count()
    assert frames.forecast.count() == units
    assert frames.forecast.select("equipment_id").distinct().count() == units


def test_alert_rows_are_equipment_days(frames):
    days = frames.stg.filter(~F.col("is_out_of_range")).select("event_date", "equipment_id").distinct().count()
    assert frames.alerts.count() == days


def test_scale_out_fixture_names_one_unit_per_user(spark):
    f = Frames(spark, SF, scale_out=True)
    users = spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    assert f.raw.select("equipment_id").distinct().count() == users
