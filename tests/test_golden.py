"""Hand-made golden rows for every threshold edge (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import make_raw
from millstat.functions import rules
from millstat.operators import anomaly, marts, staging
from millstat.params import Params
from millstat.plans import energy_reports as E

T0 = dt.datetime(2024, 1, 1, 10, 0)


def test_dedup_keeps_newest_load(spark):
    raw = make_raw(spark, [
        dict(load_timestamp=dt.datetime(2024, 1, 1, 10, 0), health_score=1.0, event_id=1),
        dict(load_timestamp=dt.datetime(2024, 1, 1, 10, 5), health_score=2.0, event_id=2),
    ])
    assert [r.health_score for r in staging.dedup_latest(raw).collect()] == [2.0]


def test_dedup_null_load_counts_as_newest(spark):
    raw = make_raw(spark, [
        dict(load_timestamp=None, health_score=1.0, event_id=1),
        dict(load_timestamp=dt.datetime(2024, 1, 1, 10, 5), health_score=2.0, event_id=2),
    ])
    assert [r.health_score for r in staging.dedup_latest(raw).collect()] == [1.0]


def test_dedup_is_idempotent(spark):
    raw = make_raw(spark, [dict(event_id=i, load_timestamp=T0 + dt.timedelta(minutes=i % 3),
                                timestamp=T0 + dt.timedelta(minutes=i % 4)) for i in range(20)])
    once = staging.dedup_latest(raw, tie_breakers=[F.col("event_id").desc()])
    twice = staging.dedup_latest(once, tie_breakers=[F.col("event_id").desc()])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == 4


def test_not_null_filter_drops_null_keys(spark):
    raw = make_raw(spark, [dict(equipment_id=None), dict(timestamp=None, event_id=1), dict(event_id=2)])
    assert staging.stage(raw).count() == 1


@pytest.mark.parametrize("col,values,expected", [
    ("temperature", [-50.0, 500.0, -50.01, 500.01], [False, False, True, True]),
    ("vibration", [0.0, 100.0, 100.01], [False, False, True]),
    ("power_consumption", [0.0, -0.01], [False, True]),
    ("health_score", [0.0, 100.0, 100.01], [False, False, True]),
])
def test_range_flag_edges(spark, col, values, expected):
    raw = make_raw(spark, [{col: v, "event_id": i, "timestamp": T0 + dt.timedelta(minutes=i)}
                           for i, v in enumerate(values)])
    got = [r.is_out_of_range for r in staging.range_flags(raw).orderBy("event_id").collect()]
    assert got == expected


def test_all_null_readings_are_not_out_of_range(spark):
    raw = make_raw(spark, [dict(temperature=None, vibration=None, power_consumption=None, health_score=None)])
    assert staging.range_flags(raw).first().is_out_of_range is False


def test_staging_rounds_half_away(spark):
    raw = make_raw(spark, [dict(temperature=45.125, vibration=2.00005, power_consumption=-0.125)])
    r = staging.stage(raw).first()
    assert (r.temperature_celsius, r.vibration_mm_s, r.power_kw) == (45.13, 2.0001, -0.13)


def _classify(spark, pairs):
    df = spark.createDataFrame(pairs, "h double, r double")
    level, _ = rules.risk_columns(F.col("h"), F.col("r"))
    return [x[0] for x in df.select(level).collect()]


def test_risk_level_edges(spark):
    pairs = [(29.99, 0.0), (30.0, 0.0), (59.99, 0.0), (60.0, 0.0), (79.99, 0.0), (80.0, 0.0), (90.0, 20.0),
             (90.0, 20.01), (90.0, 10.01), (90.0, 5.0), (90.0, 5.01)]
    assert _classify(spark, pairs) == ["CRITICAL", "WARNING", "WARNING", "WATCH", "WATCH", "NORMAL", "WARNING",
                                       "CRITICAL", "WARNING", "NORMAL", "WATCH"]


def test_oee_class_edges(spark):
    df = spark.createDataFrame([(85.0,), (84.999,), (65.0,), (50.0,), (49.99,)], "x double")
    got = [r[0] for r in df.select(rules.oee_class(F.col("x"))).collect()]
    assert got == ["WORLD CLASS", "GOOD", "GOOD", "FAIR", "POOR"]


def test_oee_weakest(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.5), (0.9, 0.4, 0.4), (0.9, None, 0.4)], "a double, p double, q double")
    got = [r[0] for r in df.select(marts.oee_weakest(F.col("a"), F.col("p"), F.col("q"))).collect()]
    assert got == ["Availability", "Performance", "Quality"]


def test_oee_availability(spark):
    df = spark.createDataFrame([(1440,), (720,), (1500,)], "n long")
    got = [r[0] for r in df.select(marts.oee_availability(F.col("n"), 1440)).collect()]
    assert got == [1.0, 0.5, 1.0]


def test_oee_performance_zero_benchmark_and_null_type(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, None)], "avg double, bench double")
    got = [r[0] for r in df.select(marts.oee_performance(F.col("avg"), F.col("bench"))).collect()]
    assert got == [0.0, None]


def _staged(spark, series, unit="Motor_001", etype="Motor", start=dt.date(2024, 1, 1), skip=()):
    """One in-range reading per day with the given health values."""
    rows, day = [], start
    for h in series:
        while day in skip:
            day += dt.timedelta(days=1)
        rows.append(dict(timestamp=dt.datetime.combine(day, dt.time(12)), equipment_id=unit,
                         equipment_type=etype, health_score=float(h), event_id=len(rows)))
        day += dt.timedelta(days=1)
    return staging.stage(make_raw(spark, rows))


def _forecast(spark, series, **kw):
    stg = _staged(spark, series, **kw)
    as_of = stg.agg(F.max("event_date")).first()[0]
    return marts.fact_forecast(stg, Params(as_of=as_of)).first()


def test_lag_needs_seven_rows(spark):
    assert _forecast(spark, [90, 89, 88, 87, 86, 85]).health_7d_ago is None
    assert _forecast(spark, [90, 89, 88, 87, 86, 85, 84]).health_7d_ago == 90.0


def test_lag_counts_rows_not_calendar_days(spark):
    r = _forecast(spark, [90, 89, 88, 87, 86, 85, 84], skip={dt.date(2024, 1, 3)})
    assert r.health_7d_ago == 90.0


def test_forecast_linear_decline(spark):
    r = _forecast(spark, [90, 89, 88, 87, 86, 85, 84])
    assert (r.avg_daily_decline, r.days_to_failure, r.urgency_level) == (1.0, 54.0, "LOW")


@pytest.mark.parametrize("series,days,level", [
    ([80] * 7, None, "STABLE"),
    ([70, 71, 72, 73, 74, 75, 76], None, "STABLE"),
    ([36, 35, 34, 33, 32, 31, 30], 0.0, "CRITICAL NOW"),
    ([31, 30, 29, 28, 27, 26, 25], 0.0, "CRITICAL NOW"),
    ([20, 21, 22, 23, 24, 25, 25], None, "CRITICAL NOW"),
])
def test_forecast_shapes(spark, series, days, level):
    r = _forecast(spark, series)
    assert (r.days_to_failure, r.urgency_level) == (days, level)


def test_forecast_without_lag_is_stable(spark):
    r = _forecast(spark, [50, 49])
    assert (r.avg_daily_decline, r.days_to_failure, r.urgency_level) == (0.0, None, "STABLE")


def test_urgency_edges(spark):
    df = spark.createDataFrame([(50.0, d) for d in (3.0, 3.1, 7.0, 7.1, 14.0, 14.1)], "h double, d double")
    level, _ = rules.urgency_columns(F.col("h"), F.col("d"), 30.0)
    assert [r[0] for r in df.select(level).collect()] == ["CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_failure_date_rounds_half_away(spark):
    df = spark.createDataFrame([(dt.date(2026, 3, 30), 2.4), (dt.date(2026, 3, 30), 2.5)], "d date, x double")
    got = [r[0] for r in df.select(marts.failure_date(F.col("d"), F.col("x"))).collect()]
    assert got == [dt.date(2026, 4, 1), dt.date(2026, 4, 2)]


@pytest.mark.parametrize("health,z,flag", [(70.01, 2.5, 0), (70.0, 2.5, 1), (50.01, 1.8, 0), (50.0, 1.8, 1),
                                            (90.0, 3.0, 0), (60.0, 2.0, 0), (40.0, 1.5, 0)])
def test_spike_threshold_by_health(spark, health, z, flag):
    # Motor vibration: mean 2.5, std 0.5 -> value = mean + z * std
    raw = make_raw(spark, [dict(health_score=health, vibration=2.5 + z * 0.5)])
    spiked = anomaly.with_spikes(raw)
    got, _ = anomaly.anomaly_columns(spiked)
    assert spiked.select(got).first()[0] == flag


def test_budget_edges(spark):
    energy = spark.createDataFrame(
        [(dt.datetime(2024, 1, 29, h), dt.date(2024, 1, 29) + dt.timedelta(days=d), v)
         for d, (h, v) in enumerate([(1, 150.0), (2, 150.01)])],
        "event_hour timestamp_ntz, event_date date, total_power_kwh double")
    energy = energy.withColumn("event_hour", F.col("event_date").cast("timestamp_ntz"))
    got = {r.event_date: r.budget_status for r in E.daily_budget(energy, Params()).collect()}
    assert got == {dt.date(2024, 1, 29): "WITHIN", dt.date(2024, 1, 30): "OVER"}


def test_efficiency_filters_non_positive_temperature(spark):
    energy = spark.createDataFrame(
        [(dt.datetime(2024, 1, 29, 1), dt.date(2024, 1, 29), "M", "Motor", -1.0, 10.0),
         (dt.datetime(2024, 1, 29, 2), dt.date(2024, 1, 29), "M", "Motor", 4.0, 10.0)],
        "event_hour timestamp_ntz, event_date date, equipment_id string, equipment_type string, "
        "avg_temperature_c double, total_power_kwh double")
    rows = E.temp_efficiency(energy, Params()).collect()
    assert [r.efficiency_ratio for r in rows] == [2.0]


def test_oee_null_type_has_no_benchmark(spark):
    rows = [dict(timestamp=T0 + dt.timedelta(minutes=i), equipment_id="X_1", equipment_type=None,
                 power_consumption=5.0, event_id=i) for i in range(3)]
    rows += [dict(timestamp=T0 + dt.timedelta(minutes=i), equipment_id="Motor_001", event_id=10 + i)
             for i in range(3)]
    stg = staging.stage(make_raw(spark, rows))
    got = {r.equipment_id: r for r in marts.fact_oee(stg, Params()).collect()}
    assert got["X_1"].benchmark_power_kw is None and got["X_1"].performance_pct is None
    assert got["X_1"].oee_class == "POOR" and got["X_1"].weakest_component == "Quality"
    assert got["Motor_001"].performance_pct == 100.0


def test_forecast_ols_uses_calendar_days(spark):
    # 2 points per day lost over the last 7 calendar days -> slope -2, (70 - 30) / 2 = 20 days
    series = [82, 80, 78, 76, 74, 72, 70]
    stg = _staged(spark, series)
    as_of = stg.agg(F.max("event_date")).first()[0]
    r = marts.forecast_ols(stg, Params(as_of=as_of)).first()
    assert (r.days_used, r.ols_daily_decline, r.ols_days_to_failure) == (7, 2.0, 20.0)


def test_health_band_edges(spark):
    from millstat.functions import rules

    rows = [(70.01, None), (70.0, "equipment_degrading"), (50.0, "equipment_degrading"), (49.99, "poor_equipment_condition"),
            (30.0, "poor_equipment_condition"), (29.99, "critical_equipment_failure")]
    df = spark.createDataFrame([(h,) for h, _ in rows], "h double")
    assert [r[0] for r in df.select(rules.health_band(F.col("h"))).collect()] == [r for _, r in rows]


# ----------------------------------------------------------------- D7 gaps

def _hours(spark, *rows):
    import datetime as dt

    return spark.createDataFrame([(u, dt.datetime(*h)) for u, h in rows], "equipment_id string, event_hour timestamp_ntz")


def test_gap_of_a_century_is_a_range_and_expands_in_pieces(spark):
    from millstat.operators import quality

    energy = _hours(spark, ("A", (1900, 1, 1, 0)), ("A", (2024, 1, 1, 0)), ("A", (2024, 1, 1, 3)), ("B", (2024, 1, 1, 0)))
    ranges = {(str(r.first_hour), r.hours) for r in quality.missing_ranges(energy).collect()}
    assert ranges == {("1900-01-01 01:00:00", 1_086_959), ("2024-01-01 01:00:00", 2)}
    assert quality.missing_hours(energy).count() == 1_086_961
    assert quality.missing_hours(energy).distinct().count() == 1_086_961
    near = quality.missing_hours(energy, since="2020-01-01", until="2025-01-01")
    assert sorted(str(r.event_hour) for r in near.collect()) == ["2024-01-01 01:00:00", "2024-01-01 02:00:00"]
    assert quality.missing_ranges(energy, until="2023-01-01").count() == 0
    assert quality.dq_missing_hours(energy).first()["failures"] == 1_086_961


def test_gaps_at_the_edge_of_a_piece(spark):
    import datetime as dt

    from millstat.operators import quality

    start = dt.datetime(2024, 1, 1)
    for n in (1, quality.PIECE - 1, quality.PIECE, quality.PIECE + 1, 2 * quality.PIECE):
        end = start + dt.timedelta(hours=n + 1)
        energy = spark.createDataFrame([("A", start), ("A", end)], "equipment_id string, event_hour timestamp_ntz")
        got = sorted(r.event_hour for r in quality.missing_hours(energy).collect())
        assert got == [start + dt.timedelta(hours=i) for i in range(1, n + 1)]


def test_oee_expected_readings_follow_each_units_usual_day(spark):
    def days(unit, counts, step):
        return [dict(timestamp=dt.datetime(2024, 1, d + 1) + dt.timedelta(minutes=step * i), equipment_id=unit, event_id=1000 * d + i)
                for d, n in enumerate(counts) for i in range(n)]

    # one unit reads every 10 minutes, one every hour; each has short days, one a day of a single reading only
    rows = days("Motor_001", [144, 144, 36, 144], 10) + days("Motor_002", [24, 12, 24, 24, 6], 60) + days("Motor_003", [1], 60)
    daily = marts.daily_equipment(staging.stage(make_raw(spark, rows)))
    assert {r.equipment_id: r.expected_readings for r in marts.expected_readings(daily).collect()} == {
        "Motor_001": 144, "Motor_002": 24, "Motor_003": 1}
    got = marts.fact_oee(None, Params(expected_per_day=None), daily).collect()
    share = {(r.equipment_id, r.event_date.day): r.availability_pct for r in got}
    assert len(got) == 10 and share == {("Motor_001", 1): 100.0, ("Motor_001", 2): 100.0, ("Motor_001", 3): 25.0, ("Motor_001", 4): 100.0,
                                        ("Motor_002", 1): 100.0, ("Motor_002", 2): 50.0, ("Motor_002", 3): 100.0, ("Motor_002", 4): 100.0,
                                        ("Motor_002", 5): 25.0, ("Motor_003", 1): 100.0}
    # the fixed parameter stays as it was
    fixed = marts.fact_oee(None, Params(expected_per_day=288), daily).where("equipment_id = 'Motor_001' and availability_pct = 50")
    assert fixed.count() == 3 and marts.expected_readings(daily.limit(0)).count() == 0


def test_page_filter_only_filters_what_is_given(spark):
    from millstat.plans.filters import page_filter

    rows = [(dt.date(2024, 1, d), t, h) for d, t, h in [(1, "Motor", 10.0), (2, "Motor", None), (3, None, 80.0), (4, "Chiller", 80.5)]]
    mart = spark.createDataFrame(rows, "event_date date, equipment_type string, min_health_score double")
    days = lambda **kw: sorted(r.event_date.day for r in page_filter(mart, **kw).collect())
    assert days() == days(equipment_type=None) == [1, 2, 3, 4]
    assert days(start=dt.date(2024, 1, 2), end=dt.date(2024, 1, 3)) == [2, 3]
    assert days(equipment_type=["Motor"]) == [1, 2] and days(equipment_type=[]) == []
    assert days(ranges={"min_health_score": (10, 80)}) == [1, 3]
