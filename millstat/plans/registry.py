"""Registered queries: key -> (Spark plan, oracle SQL).

``Frames`` holds the lazy plans of one input directory (raw -> staged ->
marts); each registered query builds on them. Nothing here collects: every
entry returns a DataFrame that the caller runs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.keys import surrogate_key
from ..operators import anomaly, marts, quality, staging
from ..operators.anomaly import SENSORS, SPEC, STG_NAMES
from ..params import DEFAULT, Params
from ..session import scratch_path
from ..sources import fixture
from . import energy_reports as E
from . import maintenance_reports as R
from . import oee_reports as O
from .filters import page_filter
from .oracle import Oracle, date_lit, dbl, eavg, esum, hu, q, skey, ts_text

D20 = dt.date(2024, 1, 20)


class Frames:
    """Lazy plans over one input directory.

    ``materialize`` names the intermediates (stg, daily, energy, alerts,
    oee, forecast) that a query reads in more than one branch; those are
    written once as parquet tables in the session's shared folder and read
    back. Otherwise each branch would re-run the scan, the dedup shuffle and
    the aggregate (branches pruned differently do not share exchanges).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, p: Params = DEFAULT, scale_out: bool = False,
                 materialize: tuple[str, ...] = ()):
        self.spark, self.sf_dir, self.p, self.scale_out = spark, sf_dir, p, scale_out
        self.materialize = set(materialize)

    # tables that only depend on the level before them are written together
    LEVELS = (("stg",), ("energy", "daily"), ("alerts", "oee", "forecast"))

    def prepare(self) -> "Frames":
        """Write the requested intermediates level by level, independent ones as concurrent jobs."""
        from .build import _run_all

        for level in self.LEVELS:
            names = [n for n in level if n in self.materialize]
            _run_all([lambda n=n: getattr(self, n) for n in names])
        return self

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.materialize:
            return df
        path = scratch_path(self.spark, f"tables/{name}")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def raw(self) -> DataFrame:
        return fixture.raw_readings(self.spark, self.sf_dir, scale_out=self.scale_out)

    @cached_property
    def stg(self) -> DataFrame:
        return self._keep("stg", staging.stage(self.raw, self.p))

    @cached_property
    def energy(self) -> DataFrame:
        return self._keep("energy", marts.fact_energy(self.stg, self.p))

    @cached_property
    def daily(self) -> DataFrame:
        return self._keep("daily", marts.daily_equipment(self.stg))

    @cached_property
    def alerts(self) -> DataFrame:
        return self._keep("alerts", marts.alert_maintenance(self.stg, self.p, self.daily))

    @cached_property
    def oee(self) -> DataFrame:
        return self._keep("oee", marts.fact_oee(self.stg, self.p, self.daily))

    @cached_property
    def forecast(self) -> DataFrame:
        return self._keep("forecast", marts.fact_forecast(self.stg, self.p, self.daily))


@dataclass
class Entry:
    run: Callable[[Frames], DataFrame]
    sql: Callable[[Oracle], str] | None
    params: Params = DEFAULT
    shared: tuple[str, ...] = ()


REGISTRY: dict[str, Entry] = {}


def reg(key: str, sql: Callable[[Oracle], str] | None, params: Params = DEFAULT, shared: tuple[str, ...] = ()):
    """Register a query; ``shared`` names intermediates it reads in several branches."""
    def deco(fn):
        REGISTRY[key] = Entry(fn, sql, params, shared)
        return fn
    return deco


def run(key: str, spark: SparkSession, sf_dir: str, scale_out: bool = False) -> DataFrame:
    e = REGISTRY[key]
    return e.run(Frames(spark, sf_dir, e.params, scale_out=scale_out, materialize=e.shared).prepare())


class BuiltFrames(Frames):
    """Frames whose staging and marts are the tables of a finished build.

    Open once per session and pass to several reports: each table is read
    (and its partitions listed) once.
    """

    def __init__(self, spark: SparkSession, paths: dict[str, str], p: Params = DEFAULT, sf_dir: str = ""):
        super().__init__(spark, sf_dir, p)
        self.paths = paths

    def _table(self, name: str) -> DataFrame:
        if name not in self.paths:
            raise KeyError(f"the build has no {name!r} table")
        return self.spark.read.parquet(self.paths[name])

    @cached_property
    def stg(self) -> DataFrame:
        return self._table("stg")

    @cached_property
    def energy(self) -> DataFrame:
        return self._table("energy")

    @cached_property
    def daily(self) -> DataFrame:
        return self._table("daily")

    @cached_property
    def alerts(self) -> DataFrame:
        return self._table("alert")

    @cached_property
    def oee(self) -> DataFrame:
        return self._table("oee")

    @cached_property
    def forecast(self) -> DataFrame:
        return self._table("forecast")


def run_on_build(key: str, frames: BuiltFrames) -> DataFrame:
    """A registered report over the tables of a finished build (``build_marts`` paths).

    The build must have used the same parameters as the report (as-of date,
    expected readings per day).
    """
    return REGISTRY[key].run(frames)


def oracle_sql(key: str) -> str | None:
    e = REGISTRY[key]
    return None if e.sql is None else e.sql(Oracle(e.params))


# ============================================================== helpers (SQL)

P = DEFAULT
CADENCE = DEFAULT.with_(expected_per_day=None)  # the usual day of each unit, at any size of input
P20 = DEFAULT.with_(as_of=D20)
SINCE = P.as_of - dt.timedelta(days=P.lookback_days)
W7 = f"event_date >= {date_lit(SINCE)} AND event_hour >= CAST({date_lit(SINCE)} AS TIMESTAMP)"
D7 = f"event_date >= {date_lit(SINCE)}"
RAW_COLS = ('"timestamp", equipment_id, equipment_type, health_score, temperature, vibration, '
            'power_consumption, is_anomaly, anomaly_reason, load_timestamp, event_id')


def spec_case(sensor: str, idx: int) -> str:
    arms = " ".join(f"WHEN {q(t)} THEN {dbl(v[sensor][idx])}" for t, v in SPEC.items())
    return f"(CASE equipment_type {arms} END)"


def z_sql(sensor: str) -> str:
    col = STG_NAMES[sensor]
    return f"abs({col} - {spec_case(sensor, 0)}) / {spec_case(sensor, 1)}"


THR = (f"(CASE WHEN health_score > 70 THEN {dbl(P.spike_sigma_healthy)} "
       f"WHEN health_score > 50 THEN {dbl(P.spike_sigma_degrading)} ELSE {dbl(P.spike_sigma_critical)} END)")


def spike_sql(sensor: str) -> str:
    return f"coalesce({z_sql(sensor)} > {THR}, false)"


# ============================================================== staging S1-S10

@reg("dedup_latest", lambda o: o.sql(f"SELECT {RAW_COLS} FROM dedup", "dedup"))
def _s1(f: Frames):
    return staging.dedup_latest(staging.not_null_filter(f.raw), tie_breakers=[F.col("event_id").desc()])


@reg("not_null_filter", lambda o: o.sql(
    f"SELECT {RAW_COLS} FROM raw WHERE \"timestamp\" IS NOT NULL AND equipment_id IS NOT NULL", "raw"))
def _s2(f: Frames):
    return staging.not_null_filter(f.raw)


@reg("range_flags", lambda o: o.sql(f"SELECT {RAW_COLS}, is_out_of_range FROM flagged", "flagged"))
def _s3(f: Frames):
    return staging.range_flags(f.raw, f.p)


@reg("clean_rounding", lambda o: o.sql(
    f"SELECT event_id, {hu('temperature', 2)} AS temperature_celsius, {hu('vibration', 4)} AS vibration_mm_s, "
    f"{hu('power_consumption', 2)} AS power_kw, {hu('health_score', 2)} AS health_score FROM raw", "raw"))
def _s4(f: Frames):
    return f.raw.select("event_id", *staging.rounded(f.raw))


@reg("time_parts", lambda o: o.sql(
    'SELECT event_id, "timestamp", date_trunc(\'hour\', "timestamp") AS event_hour, '
    'CAST("timestamp" AS DATE) AS event_date FROM raw', "raw"))
def _s5(f: Frames):
    return f.raw.select("event_id", "timestamp", *staging.time_parts())


@reg("surrogate_key", lambda o: o.sql(
    f"SELECT event_id, {skey(ts_text(chr(34) + 'timestamp' + chr(34)), 'equipment_id')} AS sensor_id FROM raw", "raw"))
def _s6(f: Frames):
    return f.raw.select("event_id", surrogate_key(f.raw, "timestamp", "equipment_id").alias("sensor_id"))


@reg("stg_sensor", lambda o: o.sql("SELECT * FROM stg", "stg"))
def _s7(f: Frames):
    return f.stg


@reg("null_out_of_range", lambda o: o.sql(f"""
SELECT sensor_id, event_timestamp, equipment_id,
  CASE WHEN temperature_celsius BETWEEN {dbl(P.limits.temp_min)} AND {dbl(P.null_temp_max)} THEN temperature_celsius END AS temperature_celsius,
  CASE WHEN vibration_mm_s BETWEEN {dbl(P.limits.vib_min)} AND {dbl(P.limits.vib_max)} THEN vibration_mm_s END AS vibration_mm_s,
  CASE WHEN power_kw >= {dbl(P.limits.power_min)} THEN power_kw END AS power_kw,
  CASE WHEN health_score BETWEEN {dbl(P.limits.health_min)} AND {dbl(P.limits.health_max)} THEN health_score END AS health_score
FROM stg""", "stg"))
def _s8(f: Frames):
    return staging.null_out_of_range(f.stg, f.p)


@reg("quality_flag", lambda o: o.sql("""
SELECT sensor_id, event_timestamp, equipment_id,
  CASE WHEN temperature_celsius IS NULL THEN 'missing_temperature'
       WHEN vibration_mm_s IS NULL THEN 'missing_vibration' ELSE 'valid' END AS data_quality_flag
FROM stg""", "stg"))
def _s9(f: Frames):
    return staging.quality_flag(f.stg)


@reg("valid_only", lambda o: o.sql("SELECT * FROM valid", "valid"))
def _s10(f: Frames):
    return staging.valid_only(f.stg)


# ============================================================== anomaly A1-A9

@reg("sensor_deviation", lambda o: o.sql(
    "SELECT sensor_id, equipment_id, equipment_type, event_timestamp, "
    + ", ".join(f"{hu(z_sql(s), 4)} AS {s}_z" for s in SENSORS) + " FROM stg", "stg"))
def _a1(f: Frames):
    return anomaly.sensor_deviation(f.stg, f.p)


@reg("anomaly_score", lambda o: o.sql(
    f"SELECT sensor_id, equipment_id, event_timestamp, health_score, {THR} AS spike_threshold, "
    f"CAST(CASE WHEN {' OR '.join(spike_sql(s) for s in SENSORS)} THEN 1 ELSE 0 END AS INTEGER) AS detected_anomaly, "
    "NULLIF(concat_ws(', ', " + ", ".join(f"CASE WHEN {spike_sql(s)} THEN {q(s + '_spike')} END" for s in SENSORS)
    + "), '') AS detected_reason FROM stg", "stg"))
def _a2(f: Frames):
    return anomaly.anomaly_score(f.stg, f.p)


def _oos(s: str) -> str:
    col = STG_NAMES[s]
    return f"coalesce({col} < {spec_case(s, 2)} OR {col} > {spec_case(s, 3)}, false)"


@reg("sensor_range_check", lambda o: o.sql(
    f"SELECT sensor_id, equipment_id, event_timestamp, ({' OR '.join(_oos(s) for s in SENSORS)}) AS out_of_spec, "
    "NULLIF(concat_ws(', ', " + ", ".join(f"CASE WHEN {_oos(s)} THEN {q(s)} END" for s in SENSORS)
    + "), '') AS out_of_spec_sensors FROM stg", "stg"))
def _a3(f: Frames):
    return anomaly.sensor_range_check(f.stg, f.p)


def _health_band_sql() -> str:
    # literals, not the rule table of the code under test
    return ("CASE WHEN health_score IS NULL OR health_score > 70 THEN NULL WHEN health_score >= 50 THEN 'equipment_degrading' "
            "WHEN health_score >= 30 THEN 'poor_equipment_condition' ELSE 'critical_equipment_failure' END")


@reg("health_band", lambda o: o.sql(
    f"SELECT sensor_id, equipment_id, event_timestamp, health_score, {_health_band_sql()} AS health_reason FROM stg",
    "stg"))
def _a4(f: Frames):
    return anomaly.health_band(f.stg, f.p)


def _severity_sql(col: str) -> str:
    arms = " ".join(f"WHEN {col} < {dbl(lim)} THEN {q(n)}" for n, lim in rules.SEVERITY_BANDS)
    return f"CASE {arms} ELSE {q(rules.SEVERITY_DEFAULT)} END"


@reg("row_severity", lambda o: o.sql(
    "SELECT sensor_id, event_timestamp, equipment_id, equipment_type, health_score, anomaly_reason, "
    f"{_severity_sql('health_score')} AS alert_severity FROM stg WHERE is_anomaly = 1 AND health_score < 50", "stg"))
def _a5(f: Frames):
    return anomaly.row_severity(f.stg, f.p)


@reg("correlated_spikes", lambda o: o.sql(f"""
SELECT equipment_id, equipment_type, readings, correlated_readings,
  {hu('correlated_readings * 100e0 / readings', 2)} AS correlated_pct
FROM (SELECT equipment_id, equipment_type, count(*) AS readings,
        CAST(sum(CASE WHEN ({' + '.join(f'CAST({spike_sql(s)} AS INTEGER)' for s in SENSORS)}) >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS correlated_readings
      FROM stg GROUP BY equipment_id, equipment_type) t""", "stg"))
def _a6(f: Frames):
    return anomaly.correlated_spikes(f.stg, f.p)


@reg("sensor_corr", lambda o: o.sql(
    f"SELECT equipment_type, {hu('corr(temperature_celsius, power_kw)', 4)} AS temp_power_corr, "
    "count(*) AS readings FROM stg GROUP BY equipment_type", "stg"))
def _a7(f: Frames):
    return anomaly.sensor_corr(f.stg, f.p)


@reg("dataset_profile", lambda o: o.sql(
    'SELECT count(*) AS total_rows, min("timestamp") AS first_reading, max("timestamp") AS last_reading, '
    "count(DISTINCT equipment_id) AS equipment_count, "
    f"{hu('sum(is_anomaly) * 100e0 / count(is_anomaly)', 2)} AS anomaly_rate_pct FROM raw", "raw"))
def _a8(f: Frames):
    return anomaly.dataset_profile(f.raw, f.p)


_DAY_X = (f"(CAST(date_diff('day', {date_lit(P.as_of)}, event_date) AS DOUBLE) + "
          "(hour(event_timestamp) * 60 + minute(event_timestamp)) / 1440e0)")


@reg("decline_rate", lambda o: o.sql(f"""
SELECT equipment_id, readings, {hu('-slope', 4)} AS health_loss_per_day,
  CASE WHEN -slope > 0 THEN {hu('100e0 / (-slope)', 1)} END AS days_100_to_0
FROM (SELECT equipment_id, regr_slope(health_score, {_DAY_X}) AS slope, count(*) AS readings
      FROM stg WHERE health_score IS NOT NULL GROUP BY equipment_id) t""", "stg"))
def _a9(f: Frames):
    return anomaly.decline_rate(f.stg, f.p)


# ============================================================== marts M1-M4

@reg("fact_energy", lambda o: o.sql("SELECT * FROM energy", "energy"))
def _m1(f: Frames):
    return f.energy


@reg("energy_kwh", lambda o: o.sql(
    "SELECT fact_id, event_hour, equipment_id, equipment_type, total_power_kwh, "
    f"{hu('total_power_kwh / 60e0', 4)} AS energy_kwh FROM energy", "energy"))
def _m1b(f: Frames):
    return marts.energy_kwh(f.energy, f.p)


@reg("alert_maintenance", lambda o: o.sql("SELECT * FROM alert", "alert"))
def _m2(f: Frames):
    return f.alerts


@reg("risk_level", lambda o: o.sql(
    "SELECT alert_id, event_date, equipment_id, min_health_score, anomaly_rate_pct, risk_level, "
    "recommended_action FROM alert", "alert"))
def _m2a(f: Frames):
    return f.alerts.select("alert_id", "event_date", "equipment_id", "min_health_score",
                           "anomaly_rate_pct", "risk_level", "recommended_action")


@reg("anomaly_rate", lambda o: o.sql(
    "SELECT alert_id, total_anomalies, total_readings, anomaly_rate_pct FROM alert", "alert"))
def _m2b(f: Frames):
    return f.alerts.select("alert_id", "total_anomalies", "total_readings", "anomaly_rate_pct")


@reg("fact_oee", lambda o: o.sql("SELECT * FROM oee", "oee"), shared=('daily',))
def _m3(f: Frames):
    return f.oee


@reg("fact_oee_x72", lambda o: o.sql("SELECT * FROM oee", "oee"), params=DEFAULT.with_(expected_per_day=72), shared=('daily',))
def _m3x(f: Frames):
    return f.oee


@reg("fact_oee_cadence", lambda o: o.sql("SELECT * FROM oee", "oee"), params=CADENCE, shared=('daily',))
def _m3y(f: Frames):
    return f.oee


@reg("oee_expected_readings", lambda o: o.sql("SELECT equipment_id, expected_readings FROM cadence", "cadence"))
def _m3z(f: Frames):
    return marts.expected_readings(f.daily)


@reg("oee_availability", lambda o: o.sql(
    "SELECT oee_id, actual_readings, availability_pct FROM oee", "oee"), params=CADENCE, shared=('daily',))
def _m3a(f: Frames):
    return f.oee.select("oee_id", "actual_readings", "availability_pct")


@reg("oee_benchmark", lambda o: o.sql("SELECT * FROM bench", "bench"))
def _m3b(f: Frames):
    return marts.oee_benchmark(f.daily)


@reg("oee_performance", lambda o: o.sql(
    "SELECT oee_id, avg_power_kw, benchmark_power_kw, performance_pct FROM oee", "oee"), shared=('daily',))
def _m3c(f: Frames):
    return f.oee.select("oee_id", "avg_power_kw", "benchmark_power_kw", "performance_pct")


@reg("oee_quality", lambda o: o.sql(
    "SELECT oee_id, anomaly_count, actual_readings, quality_pct FROM oee", "oee"), shared=('daily',))
def _m3d(f: Frames):
    return f.oee.select("oee_id", "anomaly_count", "actual_readings", "quality_pct")


@reg("oee_class", lambda o: o.sql("SELECT oee_id, oee_score, oee_class FROM oee", "oee"), params=CADENCE, shared=('daily',))
def _m3e(f: Frames):
    return f.oee.select("oee_id", "oee_score", "oee_class")


@reg("oee_weakest", lambda o: o.sql(
    "SELECT oee_id, availability_pct, performance_pct, quality_pct, weakest_component FROM oee", "oee"),
    params=CADENCE, shared=('daily',))
def _m3f(f: Frames):
    return f.oee.select("oee_id", "availability_pct", "performance_pct", "quality_pct", "weakest_component")


@reg("fact_forecast", lambda o: o.sql("SELECT * FROM forecast", "forecast"))
def _m4(f: Frames):
    return f.forecast


@reg("fact_forecast_d20", lambda o: o.sql("SELECT * FROM forecast", "forecast"), params=P20)
def _m4_20(f: Frames):
    return f.forecast


@reg("daily_health", lambda o: o.sql("SELECT * FROM forecast_dh", "forecast_dh"))
def _m4a(f: Frames):
    return marts.daily_health(f.stg, f.p, f.daily)


@reg("health_lag", lambda o: o.sql(
    "SELECT event_date, equipment_id, daily_avg_health, health_7d_ago, health_yesterday FROM forecast_lag",
    "forecast_lag"))
def _m4b(f: Frames):
    lagged = marts.health_lag(marts.daily_health(f.stg, f.p, f.daily), f.p)
    return lagged.select("event_date", "equipment_id", "daily_avg_health", "health_7d_ago", "health_yesterday")


@reg("latest_per_equipment", lambda o: o.sql(
    "SELECT event_date, equipment_id, daily_avg_health, health_7d_ago FROM forecast_lag WHERE rn = 1",
    "forecast_lag"))
def _m4c(f: Frames):
    lagged = marts.health_lag(marts.daily_health(f.stg, f.p, f.daily), f.p)
    return marts.latest_per_equipment(lagged).select("event_date", "equipment_id", "daily_avg_health",
                                                     "health_7d_ago")


@reg("decline_forecast", lambda o: o.sql(
    "SELECT forecast_id, equipment_id, current_health_score, health_7d_ago, avg_daily_decline, "
    "days_to_failure FROM forecast", "forecast"))
def _m4d(f: Frames):
    return f.forecast.select("forecast_id", "equipment_id", "current_health_score", "health_7d_ago",
                             "avg_daily_decline", "days_to_failure")


@reg("failure_date", lambda o: o.sql(
    "SELECT forecast_id, forecast_as_of_date, days_to_failure, predicted_failure_date FROM forecast",
    "forecast"), params=P20)
def _m4e(f: Frames):
    return f.forecast.select("forecast_id", "forecast_as_of_date", "days_to_failure", "predicted_failure_date")


@reg("urgency", lambda o: o.sql(
    "SELECT forecast_id, equipment_id, urgency_level, recommended_action FROM forecast", "forecast"))
def _m4f(f: Frames):
    return f.forecast.select("forecast_id", "equipment_id", "urgency_level", "recommended_action")


def _rank_sql(col: str) -> str:
    arms = " ".join(f"WHEN {q(n)} THEN {i + 1}" for i, n in enumerate(rules.URGENCY_RANK))
    return f"CAST(CASE {col} {arms} ELSE {len(rules.URGENCY_RANK) + 1} END AS INTEGER)"


@reg("urgency_order", lambda o: o.sql(
    f"SELECT *, {_rank_sql('urgency_level')} AS urgency_rank FROM forecast "
    "ORDER BY urgency_rank, days_to_failure ASC NULLS LAST, equipment_id", "forecast"))
def _m4g(f: Frames):
    return marts.urgency_order(f.forecast)


@reg("forecast_ols", lambda o: o.sql(f"""
SELECT equipment_id, days_used, current_health_score, {hu('-slope', 4)} AS ols_daily_decline,
  {hu(f'CASE WHEN -slope IS NULL OR -slope <= 0 THEN NULL WHEN current_health_score <= {dbl(P.critical_health)} THEN 0e0 ELSE (current_health_score - {dbl(P.critical_health)}) / (-slope) END', 1)} AS ols_days_to_failure
FROM (SELECT equipment_id,
        regr_slope(daily_avg_health, CAST(date_diff('day', {date_lit(P.as_of)}, event_date) AS DOUBLE)) AS slope,
        count(*) AS days_used, arg_max(daily_avg_health, event_date) AS current_health_score
      FROM forecast_dh WHERE event_date > {date_lit(SINCE)} GROUP BY equipment_id) t""", "forecast_dh"))
def _m4h(f: Frames):
    return marts.forecast_ols(f.stg, f.p, f.daily)


@reg("health_day_change", lambda o: o.sql(
    "SELECT event_date, equipment_id, daily_avg_health, health_yesterday, "
    f"{hu('daily_avg_health - health_yesterday', 2)} AS health_change_1d FROM forecast_lag", "forecast_lag"))
def _m4i(f: Frames):
    return marts.health_day_change(f.stg, f.p, f.daily)


# ============================================================== energy queries Q1-Q15

def _kwh(d: int = 2) -> str:
    return hu(esum("total_power_kwh", 2), d)


@reg("energy_by_type", lambda o: o.sql(f"""
SELECT equipment_type, count(*) AS hourly_readings, {_kwh()} AS total_kwh,
  {hu(eavg('total_power_kwh', 2), 2)} AS avg_kwh_per_hour, {hu('max(total_power_kwh)', 2)} AS peak_kwh,
  {hu('min(total_power_kwh)', 2)} AS min_kwh
FROM energy WHERE {W7} GROUP BY equipment_type ORDER BY total_kwh DESC, equipment_type""", "energy"))
def _q1(f: Frames):
    return E.energy_by_type(f.energy, f.p)


@reg("hourly_trend", lambda o: o.sql(f"""
SELECT event_hour, {_kwh()} AS hourly_total_kwh, count(DISTINCT equipment_id) AS equipment_count,
  {hu(eavg('avg_temperature_c', 2), 1)} AS avg_factory_temp
FROM energy WHERE {W7} GROUP BY event_hour ORDER BY event_hour""", "energy"))
def _q2(f: Frames):
    return E.hourly_trend(f.energy, f.p)


@reg("energy_by_equipment", lambda o: o.sql(f"""
SELECT equipment_id, equipment_type, count(*) AS hourly_readings, {_kwh()} AS total_kwh,
  {hu(eavg('total_power_kwh', 2), 2)} AS avg_kwh_per_hour,
  {hu(esum('total_power_kwh', 2) + ' / count(*)', 2)} AS kwh_per_reading,
  {hu(eavg('avg_temperature_c', 2), 2)} AS avg_operating_temp,
  {hu(eavg('max_vibration', 4), 2)} AS avg_vibration
FROM energy WHERE {W7} GROUP BY equipment_id, equipment_type ORDER BY total_kwh DESC, equipment_id""", "energy"))
def _q3(f: Frames):
    return E.energy_by_equipment(f.energy, f.p)


_PEAK = f"""
SELECT CAST(hour(event_hour) AS INTEGER) AS hour_of_day, {hu(eavg('total_power_kwh', 2), 2)} AS avg_kwh,
  count(*) AS samples, {hu('max(total_power_kwh)', 2)} AS peak_kwh, {_kwh()} AS total_kwh
FROM energy WHERE {W7} GROUP BY hour(event_hour)"""


@reg("peak_hour", lambda o: o.sql(_PEAK + " ORDER BY avg_kwh DESC, hour_of_day", "energy"))
def _q4(f: Frames):
    return E.peak_hour(f.energy, f.p)


@reg("peak_hour_top1", lambda o: o.sql(
    f"SELECT hour_of_day, avg_kwh FROM ({_PEAK}) t ORDER BY avg_kwh DESC, hour_of_day LIMIT 1", "energy"))
def _q4b(f: Frames):
    return E.peak_hour_top1(f.energy, f.p)


@reg("temp_efficiency_top50", lambda o: o.sql(f"""
SELECT equipment_id, equipment_type, event_hour, {hu('avg_temperature_c', 2)} AS temp_celsius,
  {hu('total_power_kwh', 2)} AS kwh,
  {hu('total_power_kwh / NULLIF(avg_temperature_c + 1, 0)', 2)} AS efficiency_ratio
FROM energy WHERE {W7} AND avg_temperature_c > 0
ORDER BY efficiency_ratio DESC NULLS LAST, equipment_id, event_hour LIMIT {P.top_efficiency}""", "energy"))
def _q5(f: Frames):
    return E.temp_efficiency(f.energy, f.p)


@reg("daily_budget", lambda o: o.sql(f"""
SELECT event_date, {_kwh()} AS daily_kwh, {dbl(P.daily_budget)} AS daily_budget_kwh,
  {hu(esum('total_power_kwh', 2) + ' - ' + dbl(P.daily_budget), 2)} AS variance_kwh,
  CASE WHEN {esum('total_power_kwh', 2)} > {dbl(P.daily_budget)} THEN 'OVER' ELSE 'WITHIN' END AS budget_status
FROM energy WHERE {W7} GROUP BY event_date ORDER BY event_date DESC""", "energy"))
def _q6(f: Frames):
    return E.daily_budget(f.energy, f.p)


@reg("high_power_top20", lambda o: o.sql(f"""
SELECT equipment_id, equipment_type, event_hour, total_power_kwh, avg_temperature_c, anomaly_count,
  {hu(f"total_power_kwh / (SELECT {eavg('total_power_kwh', 2)} FROM energy)", 2)} AS deviation_ratio
FROM energy WHERE {W7} AND anomaly_count > 0
ORDER BY total_power_kwh DESC, equipment_id, event_hour LIMIT {P.top_high_power}""", "energy"), shared=('energy',))
def _q7(f: Frames):
    return E.high_power(f.energy, f.p)


@reg("total_energy_7d", lambda o: o.sql(
    f"SELECT {_kwh()} AS total_kwh, {hu(esum('total_power_kwh', 2) + ' / 60e0', 2)} AS total_energy_kwh "
    f"FROM energy WHERE {W7}", "energy"))
def _q8(f: Frames):
    return E.total_energy(f.energy, f.p)


@reg("temp_power_scatter", lambda o: o.sql(
    "SELECT equipment_id, event_hour, avg_temperature_c, total_power_kwh, equipment_type "
    f"FROM energy WHERE {W7}", "energy"))
def _q9(f: Frames):
    return E.temp_power_scatter(f.energy, f.p)


@reg("mart_sample_energy", lambda o: o.sql(f"""
SELECT equipment_type, count(*) AS hourly_readings, {_kwh()} AS total_kwh,
  {hu(eavg('avg_power_kw', 2), 2)} AS avg_power_kw, {hu(eavg('avg_temperature_c', 2), 2)} AS avg_temp
FROM energy GROUP BY equipment_type ORDER BY total_kwh DESC, equipment_type""", "energy"))
def _q10(f: Frames):
    return E.mart_sample_energy(f.energy, f.p)


@reg("overheating", lambda o: o.sql(
    "SELECT fact_id, event_hour, equipment_id, equipment_type, avg_temperature_c FROM energy "
    f"WHERE avg_temperature_c > {dbl(P.overheat_temp)}", "energy"))
def _q11(f: Frames):
    return E.overheating(f.energy, f.p)


@reg("anomaly_hours", lambda o: o.sql(
    "SELECT fact_id, event_hour, equipment_id, anomaly_count, reading_count FROM energy WHERE anomaly_count > 0",
    "energy"))
def _q12(f: Frames):
    return E.anomaly_hours(f.energy, f.p)


@reg("period_rollup", lambda o: o.sql(f"""
SELECT period, period_start, equipment_type, count(*) AS hours, {_kwh()} AS total_kwh
FROM (SELECT 'week' AS period, CAST(date_trunc('week', event_hour) AS DATE) AS period_start, equipment_type, total_power_kwh FROM energy
      UNION ALL
      SELECT 'month', CAST(date_trunc('month', event_hour) AS DATE), equipment_type, total_power_kwh FROM energy) t
GROUP BY period, period_start, equipment_type""", "energy"))
def _q13(f: Frames):
    return E.period_rollup(f.energy, f.p)


@reg("energy_health_join", lambda o: o.sql(f"""
SELECT d.event_date, d.equipment_id, d.equipment_type, d.daily_kwh, d.anomaly_hours_sum,
  a.avg_health_score, a.min_health_score, a.risk_level, a.total_anomalies
FROM (SELECT event_date, equipment_id, equipment_type, {_kwh()} AS daily_kwh,
        CAST(sum(anomaly_count) AS BIGINT) AS anomaly_hours_sum
      FROM energy GROUP BY event_date, equipment_id, equipment_type) d
JOIN alert a ON d.event_date = a.event_date AND d.equipment_id = a.equipment_id
             AND d.equipment_type = a.equipment_type""", "energy", "alert"), shared=('stg',))
def _q14(f: Frames):
    return E.energy_health_join(f.energy, f.alerts, f.p)


@reg("energy_share", lambda o: o.sql(f"""
SELECT equipment_type, {hu('kwh', 2)} AS total_kwh,
  {hu(f"kwh * 100e0 / (SELECT {esum('total_power_kwh', 2)} FROM energy WHERE {W7})", 2)} AS pct_of_total
FROM (SELECT equipment_type, {esum('total_power_kwh', 2)} AS kwh FROM energy WHERE {W7} GROUP BY equipment_type) t""",
    "energy"), shared=('energy',))
def _q15(f: Frames):
    return E.energy_share(f.energy, f.p)


# ============================================================== maintenance queries R1-R12

@reg("open_alerts", lambda o: o.sql(
    "SELECT event_date, equipment_id, equipment_type, risk_level, min_health_score AS lowest_health, "
    "recommended_action FROM alert WHERE risk_level IN ('CRITICAL', 'WARNING') "
    "ORDER BY event_date DESC, risk_level DESC, equipment_id", "alert"))
def _r1(f: Frames):
    return R.open_alerts(f.alerts, f.p)


@reg("open_alerts_today", lambda o: o.sql(
    "SELECT equipment_id, risk_level, min_health_score, recommended_action FROM alert "
    f"WHERE risk_level IN ('CRITICAL', 'WARNING') AND event_date = {date_lit(P.as_of)}", "alert"))
def _r1b(f: Frames):
    return R.open_alerts_today(f.alerts, f.p)


@reg("health_trend", lambda o: o.sql(
    "SELECT event_date, equipment_id, equipment_type, avg_health_score, min_health_score FROM alert "
    f"WHERE {D7} ORDER BY equipment_id, event_date", "alert"))
def _r2(f: Frames):
    return R.health_trend(f.alerts, f.p)


@reg("risk_distribution", lambda o: o.sql(f"""
SELECT risk_level, count(*) AS record_count,
  {hu('count(*) * 100e0 / (SELECT count(*) FROM alert)', 2)} AS pct_of_total
FROM alert GROUP BY risk_level ORDER BY record_count DESC, risk_level""", "alert"), shared=('alerts',))
def _r3(f: Frames):
    return R.risk_distribution(f.alerts, f.p)


@reg("risk_distribution_last_day", lambda o: o.sql(
    "SELECT risk_level, count(*) AS alert_count FROM alert "
    f"WHERE event_date >= {date_lit(P.as_of - dt.timedelta(days=1))} GROUP BY risk_level ORDER BY risk_level",
    "alert"))
def _r3b(f: Frames):
    return R.risk_distribution_last_day(f.alerts, f.p)


@reg("risk_vs_maxima", lambda o: o.sql(f"""
SELECT risk_level, {hu(eavg('min_health_score', 2), 2)} AS avg_min_health,
  {hu(eavg('max_temperature_c', 2), 2)} AS avg_max_temp_c,
  {hu(eavg('max_vibration', 4), 4)} AS avg_max_vibration,
  {hu(eavg('max_power_kw', 2), 2)} AS avg_max_power_kw,
  CAST(sum(total_anomalies) AS BIGINT) AS total_anomalies
FROM alert GROUP BY risk_level ORDER BY avg_min_health, risk_level""", "alert"))
def _r4(f: Frames):
    return R.risk_vs_maxima(f.alerts, f.p)


@reg("anomaly_leaderboard", lambda o: o.sql(f"""
SELECT equipment_id, equipment_type, CAST(sum(total_anomalies) AS BIGINT) AS total_anomalies_recorded,
  CAST(sum(total_readings) AS BIGINT) AS total_readings_taken,
  {hu('CAST(sum(total_anomalies) AS BIGINT) * 100e0 / NULLIF(CAST(sum(total_readings) AS BIGINT), 0)', 2)} AS overall_anomaly_rate_pct,
  min(min_health_score) AS historic_lowest_health
FROM alert GROUP BY equipment_id, equipment_type""", "alert"))
def _r5(f: Frames):
    return R.anomaly_leaderboard(f.alerts, f.p)


@reg("mart_sample_alerts", lambda o: o.sql(f"""
SELECT risk_level, count(*) AS record_count, {hu(eavg('min_health_score', 2), 2)} AS avg_min_health,
  CAST(sum(total_anomalies) AS BIGINT) AS total_anomalies
FROM alert GROUP BY risk_level""", "alert"))
def _r6(f: Frames):
    return R.mart_sample_alerts(f.alerts, f.p)


@reg("failure_timeline", lambda o: o.sql(
    "SELECT equipment_id, urgency_level, current_health_score AS current_health, "
    "days_to_failure AS estimated_days_remaining, predicted_failure_date, recommended_action "
    "FROM forecast WHERE days_to_failure IS NOT NULL AND days_to_failure > 0", "forecast"))
def _r7(f: Frames):
    return R.failure_timeline(f.forecast, f.p)


@reg("anomaly_heatmap", lambda o: o.sql(
    "SELECT equipment_id, CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day, count(*) AS anomaly_count "
    f"FROM stg WHERE is_anomaly = 1 AND {D7} GROUP BY equipment_id, hour(event_timestamp)", "stg"))
def _r8(f: Frames):
    return R.anomaly_heatmap(f.stg, f.p)


@reg("anomaly_heatmap_pivot", lambda o: o.sql(
    "SELECT equipment_id, "
    + ", ".join(f"CAST(sum(CASE WHEN hour(event_timestamp) = {h} THEN 1 ELSE 0 END) AS BIGINT) AS h{h:02d}"
                for h in range(24))
    + f" FROM stg WHERE is_anomaly = 1 AND {D7} GROUP BY equipment_id", "stg"))
def _r8b(f: Frames):
    return R.anomaly_heatmap_pivot(f.stg, f.p)


@reg("current_health", lambda o: o.sql(
    "SELECT equipment_id, min(min_health_score) AS current_health, max(event_date) AS last_reading "
    "FROM alert GROUP BY equipment_id", "alert"))
def _r9(f: Frames):
    return R.current_health(f.alerts, f.p)


@reg("kpi_targets", lambda o: o.sql(f"""
SELECT kpi, value, goal,
  coalesce(CASE kpi WHEN 'critical_alerts' THEN value = 0 WHEN 'high_alerts' THEN value < 5
                    WHEN 'average_health' THEN value > 70 WHEN 'units_below_30' THEN value = 0
                    ELSE value > 14 END, false) AS met
FROM (
  SELECT 'critical_alerts' AS kpi, CAST(count(*) FILTER (WHERE risk_level = 'CRITICAL') AS DOUBLE) AS value, '= 0' AS goal
    FROM alert WHERE event_date = {date_lit(P.as_of)}
  UNION ALL
  SELECT 'high_alerts', CAST(count(*) FILTER (WHERE risk_level = 'WARNING') AS DOUBLE), '< 5'
    FROM alert WHERE event_date = {date_lit(P.as_of)}
  UNION ALL
  SELECT 'average_health', {hu(eavg('avg_health_score', 2), 2)}, '> 70' FROM alert WHERE {D7}
  UNION ALL
  SELECT 'units_below_30', CAST(count(DISTINCT CASE WHEN min_health_score < 30 THEN equipment_id END) AS DOUBLE), '= 0'
    FROM alert WHERE {D7}
  UNION ALL
  SELECT 'mean_days_to_failure', {hu(eavg('days_to_failure', 1), 2)}, '> 14' FROM forecast
) t""", "alert", "forecast"), shared=('daily', 'alerts'))
def _r10(f: Frames):
    return R.kpi_targets(f.alerts, f.forecast, f.p)


@reg("health_by_range", lambda o: o.sql(
    "SELECT alert_id, event_date, equipment_id, equipment_type, min_health_score, risk_level FROM alert "
    f"WHERE min_health_score BETWEEN 0e0 AND 80e0 AND event_date BETWEEN "
    f"{date_lit(P.as_of - dt.timedelta(days=2 * P.lookback_days))} AND {date_lit(P.as_of)} "
    "AND equipment_type IN ('Motor', 'ConveyorBelt') AND risk_level IN ('WARNING', 'WATCH')", "alert"))
def _r11(f: Frames):
    return R.health_by_range(f.alerts, 0.0, 80.0, ("Motor", "ConveyorBelt"), risks=("WARNING", "WATCH"),
                             start=f.p.as_of - dt.timedelta(days=2 * f.p.lookback_days), end=f.p.as_of)


@reg("energy_page_filter", lambda o: o.sql(
    "SELECT equipment_type, count(*) AS hourly_readings, " f"{_kwh()} AS total_kwh, "
    f"{hu(eavg('avg_power_kw', 2), 2)} AS avg_power_kw, {hu(eavg('avg_temperature_c', 2), 2)} AS avg_temp "
    f"FROM energy WHERE event_date BETWEEN {date_lit(SINCE)} AND {date_lit(P.as_of)} "
    "AND equipment_type IN ('Motor', 'Chiller') GROUP BY equipment_type", "energy"))
def _page_energy(f: Frames):
    start = f.p.as_of - dt.timedelta(days=f.p.lookback_days)
    return E.mart_sample_energy(page_filter(f.energy, start, f.p.as_of, equipment_type=("Motor", "Chiller")), f.p)


@reg("oee_page_filter", lambda o: o.sql(
    "SELECT oee_id, event_date, equipment_id, equipment_type, oee_score, oee_class FROM oee "
    "WHERE equipment_type IN ('Motor', 'ConveyorBelt') AND oee_class IN ('WORLD CLASS', 'GOOD', 'POOR')", "oee"),
    params=CADENCE, shared=('daily',))
def _page_oee(f: Frames):
    return page_filter(f.oee, equipment_type=("Motor", "ConveyorBelt"), oee_class=("WORLD CLASS", "GOOD", "POOR")).select(
        "oee_id", "event_date", "equipment_id", "equipment_type", "oee_score", "oee_class")


@reg("forecast_page_filter", lambda o: o.sql(
    "SELECT equipment_id, equipment_type, current_health_score, urgency_level FROM forecast "
    "WHERE equipment_type IN ('ConveyorBelt', 'Chiller') AND urgency_level IN ('CRITICAL NOW', 'CRITICAL', 'HIGH')", "forecast"))
def _page_forecast(f: Frames):
    return page_filter(f.forecast, equipment_type=("ConveyorBelt", "Chiller"), urgency_level=("CRITICAL NOW", "CRITICAL", "HIGH")).select(
        "equipment_id", "equipment_type", "current_health_score", "urgency_level")


def _cause_sql() -> str:
    reason = "coalesce(s.anomaly_reason, '')"
    conds = [
        f"contains({reason}, 'vibration_spike') AND fc.avg_daily_decline > 0",
        f"contains({reason}, 'temperature_spike') AND contains({reason}, 'power_consumption_spike')",
        "fc.avg_daily_decline >= 2",
        "s.is_anomaly = 1",
    ]
    sev = " ".join(f"WHEN {c} THEN {q(a[0])}" for c, a in zip(conds, rules.CAUSE_ACTIONS))
    act = " ".join(f"WHEN {c} THEN {q(a[1])}" for c, a in zip(conds, rules.CAUSE_ACTIONS))
    return f"""
SELECT s.sensor_id, s.equipment_id, s.event_timestamp, s.anomaly_reason, fc.avg_daily_decline,
  CASE {sev} ELSE {q(rules.CAUSE_DEFAULT[0])} END AS cause_severity,
  CASE {act} ELSE {q(rules.CAUSE_DEFAULT[1])} END AS cause_action
FROM stg s LEFT JOIN forecast fc ON s.equipment_id = fc.equipment_id
WHERE NOT s.is_out_of_range"""


@reg("cause_rules", lambda o: o.sql(_cause_sql(), "stg", "forecast"), shared=('stg',))
def _r12(f: Frames):
    return R.cause_rules(f.stg, f.forecast, f.p)


@reg("export_alerts", lambda o: o.sql(
    "SELECT alert_id, equipment_id, risk_level, recommended_action, event_date, "
    "CAST(NULL AS VARCHAR) AS work_order_id FROM alert WHERE risk_level IN ('CRITICAL', 'WARNING') "
    f"AND event_date >= {date_lit(P.as_of - dt.timedelta(days=1))}", "alert"))
def _i14(f: Frames):
    return R.export_alerts(f.alerts, f.p)


# ============================================================== OEE / forecast queries O1-O7

_KPI = {"oee": "oee_score", "availability": "availability_pct", "performance": "performance_pct",
        "quality": "quality_pct"}


@reg("oee_kpis", lambda o: o.sql(
    "SELECT " + ", ".join(f"{hu(eavg(c, 2), 2)} AS avg_{k}" for k, c in _KPI.items()) + " FROM oee", "oee"),
    params=CADENCE, shared=('daily',))
def _o1(f: Frames):
    return O.oee_kpis(f.oee, f.p)


@reg("world_class_machines", lambda o: o.sql(
    "SELECT count(DISTINCT CASE WHEN oee_class = 'WORLD CLASS' THEN equipment_id END) AS world_class_machines "
    "FROM oee", "oee"), params=CADENCE, shared=('daily',))
def _o2(f: Frames):
    return O.world_class_machines(f.oee, f.p)


@reg("critical_risk_count", lambda o: o.sql(
    "SELECT count(*) FILTER (WHERE urgency_level IN ('CRITICAL NOW', 'CRITICAL')) AS machines_at_critical_risk "
    "FROM forecast", "forecast"))
def _o3(f: Frames):
    return O.critical_risk_count(f.forecast, f.p)


@reg("days_to_failure_stats", lambda o: o.sql(
    f"SELECT {hu(eavg('days_to_failure', 1), 2)} AS avg_days_to_failure, "
    "min(days_to_failure) AS min_days_to_failure FROM forecast", "forecast"))
def _o4(f: Frames):
    return O.days_to_failure_stats(f.forecast, f.p)


@reg("oee_by_equipment", lambda o: o.sql(
    f"SELECT equipment_id, equipment_type, {hu(eavg('oee_score', 2), 2)} AS avg_oee_score, count(*) AS days "
    "FROM oee GROUP BY equipment_id, equipment_type", "oee"), params=CADENCE, shared=('daily',))
def _o5(f: Frames):
    return O.oee_by_equipment(f.oee, f.p)


@reg("oee_trend", lambda o: o.sql(
    "SELECT event_date, equipment_id, oee_score, availability_pct, performance_pct, quality_pct FROM oee",
    "oee"), params=CADENCE, shared=('daily',))
def _o5b(f: Frames):
    return O.oee_trend(f.oee, f.p)


def _kpi_status_sql() -> str:
    parts = []
    for k, c in _KPI.items():
        g, a = rules.KPI_BANDS[k]
        v = hu(eavg(c, 2), 2)
        parts.append(f"SELECT {q(k)} AS kpi, {v} AS value FROM oee")
    arms = " ".join(
        f"WHEN kpi = {q(k)} THEN CASE WHEN value >= {dbl(rules.KPI_BANDS[k][0])} THEN 'GREEN' "
        f"WHEN value >= {dbl(rules.KPI_BANDS[k][1])} THEN 'AMBER' ELSE 'RED' END" for k in _KPI)
    return f"SELECT kpi, value, CASE {arms} ELSE 'RED' END AS status FROM ({' UNION ALL '.join(parts)}) t"


@reg("kpi_status", lambda o: o.sql(_kpi_status_sql(), "oee"), params=CADENCE, shared=('daily',))
def _o6(f: Frames):
    return O.kpi_status(f.oee, f.p)


@reg("executive_overview", lambda o: o.sql(f"""
SELECT (SELECT {_kwh()} FROM energy WHERE {W7}) AS total_kwh_7d,
  (SELECT {hu(eavg('oee_score', 2), 2)} FROM oee) AS avg_oee_score,
  (SELECT count(*) FILTER (WHERE risk_level = 'CRITICAL') FROM alert WHERE event_date = {date_lit(P.as_of)}) AS critical_alerts_today,
  (SELECT {hu(eavg('avg_health_score', 2), 2)} FROM alert WHERE {D7}) AS avg_health_7d,
  (SELECT count(*) FILTER (WHERE urgency_level IN ('CRITICAL NOW', 'CRITICAL')) FROM forecast) AS machines_at_critical_risk,
  (SELECT count(*) FROM forecast) AS machines""", "energy", "oee", "alert", "forecast"), params=CADENCE, shared=('stg', 'daily', 'alerts', 'forecast'))
def _o7(f: Frames):
    return O.executive_overview(f.energy, f.alerts, f.oee, f.forecast, f.p)


# ============================================================== data quality D1-D7

def _dq(rows: list[tuple[str, str, str]]) -> str:
    """(rule, severity, failures-expression-with-FROM) -> stacked rule rows."""
    sel = " UNION ALL ".join(
        f"SELECT {q(r)} AS rule, {q(s)} AS severity, CAST(({expr}) AS BIGINT) AS failures" for r, s, expr in rows)
    return f"SELECT rule, severity, failures, failures = 0 AS passed FROM ({sel}) t"


def _cnt(table: str, cond: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {cond}"


NOT_NULL_ROWS = [
    ("not_null:raw.timestamp", "error", _cnt("raw", '"timestamp" IS NULL')),
    ("not_null:raw.equipment_id", "error", _cnt("raw", "equipment_id IS NULL")),
    ("not_null:stg.sensor_id", "error", _cnt("stg", "sensor_id IS NULL")),
    ("not_null:stg.event_timestamp", "error", _cnt("stg", "event_timestamp IS NULL")),
    ("not_null:stg.equipment_id", "error", _cnt("stg", "equipment_id IS NULL")),
]
UNIQUE_ROWS = [("unique:stg.sensor_id", "error",
                "SELECT count(*) FROM (SELECT sensor_id FROM stg GROUP BY sensor_id HAVING count(*) > 1) d")]


def _accepted(table: str, col: str) -> str:
    vals = ", ".join(q(v) for v in quality.ACCEPTED[col])
    return _cnt(table, f"{col} NOT IN ({vals})")


ACCEPTED_ROWS = [
    ("accepted_values:stg.equipment_type", "error", _accepted("stg", "equipment_type")),
    ("accepted_values:alert.risk_level", "error", _accepted("alert", "risk_level")),
    ("accepted_values:oee.oee_class", "error", _accepted("oee", "oee_class")),
    ("accepted_values:forecast.urgency_level", "error", _accepted("forecast", "urgency_level")),
]
REL_ROWS = [
    ("relationships:alert->stg", "error",
     "SELECT count(*) FROM alert a WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.event_date = a.event_date "
     "AND s.equipment_id = a.equipment_id)"),
    ("relationships:energy->stg", "error",
     "SELECT count(*) FROM energy e WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.event_hour = e.event_hour "
     "AND s.equipment_id = e.equipment_id)"),
]
_METRICS = ["total_power_kwh", "avg_power_kw", "peak_power_kw", "avg_temperature_c", "max_temperature_c",
            "avg_vibration", "max_vibration", "avg_health_score", "min_health_score", "anomaly_count",
            "reading_count"]
ENERGY_ROWS = [
    ("energy:not_null", "error", _cnt("energy", " OR ".join(f"{m} IS NULL" for m in _METRICS))),
    ("energy:positive_energy", "warn", _cnt("energy", "total_power_kwh <= 0")),
    ("energy:avg_temp_range", "error", _cnt("energy", "avg_temperature_c < -50 OR avg_temperature_c > 100")),
    ("energy:min_health_range", "error", _cnt("energy", "min_health_score < 0 OR min_health_score > 100")),
    ("energy:reading_count_60", "warn", _cnt("energy", "reading_count <> 60")),
]
_SPINE = """
SELECT sp.equipment_id, sp.event_hour FROM (
  SELECT equipment_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS event_hour
  FROM (SELECT equipment_id, min(event_hour) AS lo, max(event_hour) AS hi FROM energy GROUP BY equipment_id) b
) sp
WHERE NOT EXISTS (SELECT 1 FROM energy e WHERE e.equipment_id = sp.equipment_id AND e.event_hour = sp.event_hour)"""
MISSING_ROWS = [("completeness:energy.hours", "warn", f"SELECT count(*) FROM ({_SPINE}) m")]


@reg("dq_not_null", lambda o: o.sql(_dq(NOT_NULL_ROWS), "raw", "stg"))
def _d1(f: Frames):
    return quality.dq_not_null(f.raw, f.stg)


@reg("dq_unique", lambda o: o.sql(_dq(UNIQUE_ROWS), "stg"))
def _d2(f: Frames):
    return quality.dq_unique(f.stg)


@reg("dq_accepted_values", lambda o: o.sql(_dq(ACCEPTED_ROWS), "stg", "alert", "oee", "forecast"), shared=('stg', 'daily'))
def _d3(f: Frames):
    return quality.dq_accepted_values(f.stg, f.alerts, f.oee, f.forecast)


@reg("dq_relationships", lambda o: o.sql(_dq(REL_ROWS), "stg", "alert", "energy"), shared=('stg',))
def _d4(f: Frames):
    return quality.dq_relationships(f.stg, f.energy, f.alerts)


@reg("dq_energy_rules", lambda o: o.sql(_dq(ENERGY_ROWS), "energy"))
def _d5(f: Frames):
    return quality.dq_energy_rules(f.energy, f.p)


@reg("dq_report", lambda o: o.sql(
    _dq(NOT_NULL_ROWS + UNIQUE_ROWS + ACCEPTED_ROWS + REL_ROWS + ENERGY_ROWS + MISSING_ROWS),
    "raw", "stg", "alert", "oee", "forecast", "energy"), shared=('stg', 'daily', 'energy', 'alerts', 'oee', 'forecast'))
def _d6(f: Frames):
    return quality.dq_report(f.raw, f.stg, f.energy, f.alerts, f.oee, f.forecast, f.p)


@reg("missing_hours", lambda o: o.sql(_SPINE, "energy"))
def _d7(f: Frames):
    return quality.missing_hours(f.energy)


@reg("missing_ranges", lambda o: o.sql("""
SELECT equipment_id, event_hour + INTERVAL 1 HOUR AS first_hour, nxt - INTERVAL 1 HOUR AS last_hour,
  date_diff('hour', event_hour, nxt) - 1 AS hours
FROM (SELECT *, lead(event_hour) OVER (PARTITION BY equipment_id ORDER BY event_hour) AS nxt
  FROM (SELECT DISTINCT equipment_id, event_hour FROM energy) d) g
WHERE nxt > event_hour + INTERVAL 1 HOUR""", "energy"))
def _d7b(f: Frames):
    return quality.missing_ranges(f.energy)


# ingestion, build and streaming keys register themselves on import
from . import io_registry  # noqa: E402,F401
