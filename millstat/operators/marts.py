"""Mart operators (M1-M4) over staged readings.

Plan shape at scale:
* M1 is one hash aggregate (partial before the shuffle, final after) keyed
  by (hour, unit): output is ~60x smaller than the readings.
* M2, M3 and M4 share ``daily_equipment``: one aggregate keyed by
  (date, unit). Everything after it works on equipment-days, a frame that
  is tiny next to the readings.
* The OEE benchmark (max daily power per type) is a group-by on the daily
  frame joined back on type; the aggregate has one row per type, so AQE
  turns the join into a broadcast at run time. A window partitioned by
  type would instead put every equipment-day of a type in one task.
* Forecast windows are partitioned by unit on the daily frame: at most one
  row per day per unit, so no hot partition whatever the reading skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import sqltext as sq
from ..functions.keys import surrogate_key
from ..functions.numeric import half_up, least_strict, nullif, round_to_int
from ..params import DEFAULT, Params
from .staging import valid_only


def _aggs(pairs: list[tuple[str, str]]) -> list[Column]:
    """Aggregate expressions given as SQL text (one parse each, same trees as the Column helpers)."""
    return [F.expr(text).alias(name) for text, name in pairs]


def _with_key(df: DataFrame, name: str, *cols: str) -> DataFrame:
    return df.select(surrogate_key(df, *cols).alias(name), *df.columns)


# ----------------------------------------------------------------- M1

#: hourly aggregates of M1, shared by the batch and the stream
ENERGY_KEYS = ("event_hour", "event_date", "equipment_id", "equipment_type")
ENERGY_AGGS = [
    (sq.half_up(sq.exact_sum("power_kw", 2), 2), "total_power_kwh"),
    (sq.half_up(sq.exact_avg("power_kw", 2), 2), "avg_power_kw"),
    (sq.half_up("max(power_kw)", 2), "peak_power_kw"),
    (sq.half_up(sq.exact_avg("temperature_celsius", 2), 2), "avg_temperature_c"),
    (sq.half_up("max(temperature_celsius)", 2), "max_temperature_c"),
    (sq.half_up(sq.exact_avg("vibration_mm_s", 4), 4), "avg_vibration"),
    (sq.half_up("max(vibration_mm_s)", 4), "max_vibration"),
    (sq.half_up(sq.exact_avg("health_score", 2), 2), "avg_health_score"),
    (sq.half_up("min(health_score)", 2), "min_health_score"),
    ("CAST(sum(is_anomaly) AS BIGINT)", "anomaly_count"),
    ("count(1)", "reading_count"),
]


def energy_aggs() -> list[Column]:
    return _aggs(ENERGY_AGGS)


def fact_energy(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M1: one row per equipment-hour."""
    hourly = valid_only(stg).groupBy(*ENERGY_KEYS).agg(*energy_aggs())
    return _with_key(hourly, "fact_id", "event_hour", "equipment_id")


def energy_kwh(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Energy as documented - one-minute kW samples summed / 60."""
    return energy.select(
        "fact_id", "event_hour", "equipment_id", "equipment_type", "total_power_kwh",
        half_up(F.col("total_power_kwh") / 60.0, 4).alias("energy_kwh"),
    )


# ----------------------------------------------------------------- daily

def daily_equipment(stg: DataFrame) -> DataFrame:
    """Equipment-day aggregate shared by M2, M3 and M4 (in-range readings)."""
    return valid_only(stg).groupBy("event_date", "equipment_id", "equipment_type").agg(*_aggs([
        (sq.half_up(sq.exact_avg("health_score", 2), 2), "avg_health_score"),
        (sq.half_up("min(health_score)", 2), "min_health_score"),
        ("CAST(sum(is_anomaly) AS BIGINT)", "anomaly_count"),
        ("count(1)", "reading_count"),
        (sq.half_up("max(temperature_celsius)", 2), "max_temperature_c"),
        (sq.half_up("max(vibration_mm_s)", 4), "max_vibration"),
        (sq.half_up("max(power_kw)", 2), "max_power_kw"),
        (sq.half_up(sq.exact_avg("power_kw", 2), 4), "avg_power_kw"),
        (sq.half_up(sq.exact_avg("temperature_celsius", 2), 2), "avg_temperature_c"),
        (sq.half_up(sq.exact_avg("vibration_mm_s", 4), 4), "avg_vibration"),
    ]))


# ----------------------------------------------------------------- M2

def anomaly_rate(anomalies: Column, readings: Column) -> Column:
    """Percent of anomalous readings, 2 dp; NULL when no readings."""
    return half_up(anomalies * F.lit(100.0) / nullif(readings, 0), 2)


def alert_maintenance(stg: DataFrame, p: Params = DEFAULT, daily: DataFrame | None = None,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """M2: one row per equipment-day with risk level and action. ``keep``: columns of ``daily`` to pass on."""
    d = daily if daily is not None else daily_equipment(stg)
    base = d.select(
        "event_date", "equipment_id", "equipment_type", "avg_health_score", "min_health_score",
        F.col("anomaly_count").alias("total_anomalies"),
        F.col("reading_count").alias("total_readings"),
        anomaly_rate(F.col("anomaly_count"), F.col("reading_count")).alias("anomaly_rate_pct"),
        "max_temperature_c", "max_vibration", "max_power_kw", *keep,
    )
    level, action = rules.risk_columns(F.col("min_health_score"), F.col("anomaly_rate_pct"))
    out = base.select("*", level.alias("risk_level"), action.alias("recommended_action"))
    return _with_key(out, "alert_id", "event_date", "equipment_id")


# ----------------------------------------------------------------- M3

def expected_readings(daily: DataFrame) -> DataFrame:
    """Readings that a full day of each unit holds: the median (lower of two) of its daily counts.

    The median stands for the usual day: days cut short by outages, the first and the last day, or a burst
    of repeats don't move it until they are half of all days. One aggregate of the equipment-day
    frame, at most one value per day and unit; the readings are not read again. A unit with a
    single day is its own measure (100 %). NULL ids are one unit.
    """
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY reading_count)").cast("long")
    return daily.groupBy("equipment_id").agg(median.alias("expected_readings"))


def _with_expected(daily: DataFrame, p: Params) -> DataFrame:
    """``daily`` with the expected readings as ``_expected``: the parameter, or each unit's cadence."""
    if p.expected_per_day is not None:
        return daily.withColumn("_expected", F.lit(p.expected_per_day))
    usual = expected_readings(daily).select(F.col("equipment_id").alias("_unit"), F.col("expected_readings").alias("_expected"))
    return daily.join(usual, daily["equipment_id"].eqNullSafe(usual["_unit"]), "left").drop("_unit")


def oee_availability(readings: Column, expected: Column) -> Column:
    """Captured share of expected readings, capped at 1, 4 dp."""
    return half_up(F.least(readings / expected, F.lit(1.0)), 4)


def oee_performance(avg_power: Column, benchmark: Column) -> Column:
    """Average power vs the type benchmark, capped at 1, 4 dp."""
    return half_up(F.when(benchmark == 0, F.lit(0.0))
                   .otherwise(least_strict(avg_power / benchmark, F.lit(1.0))), 4)


def oee_quality(anomalies: Column, readings: Column) -> Column:
    """M3d: share of readings that are not anomalous, 4 dp."""
    return half_up(F.lit(1.0) - anomalies / nullif(readings, 0), 4)


def oee_weakest(a: Column, pf: Column, q: Column) -> Column:
    """M3f: the component equal to the (NULL-strict) least; ties in order."""
    low = least_strict(a, pf, q)
    return rules.chain([(low == a, "Availability"), (low == pf, "Performance")], "Quality")


def oee_benchmark(daily: DataFrame) -> DataFrame:
    """Best daily average power per equipment type."""
    return daily.groupBy("equipment_type").agg(F.max("avg_power_kw").alias("benchmark_power_kw"))


def fact_oee(stg: DataFrame, p: Params = DEFAULT, daily: DataFrame | None = None) -> DataFrame:
    """M3: OEE per equipment-day."""
    d = daily if daily is not None else daily_equipment(stg)
    bench = oee_benchmark(d)
    # left join on type: a NULL type finds no benchmark, as in the reference
    joined = _with_expected(d, p).join(bench, on="equipment_type", how="left")
    comp = joined.select(
        "*",
        oee_availability(F.col("reading_count"), F.col("_expected")).alias("_a"),
        oee_performance(F.col("avg_power_kw"), F.col("benchmark_power_kw")).alias("_p"),
        oee_quality(F.col("anomaly_count"), F.col("reading_count")).alias("_q"),
    )
    product = F.col("_a") * F.col("_p") * F.col("_q") * F.lit(100.0)
    out = comp.select(
        "event_date", "equipment_id", "equipment_type",
        half_up(F.col("_a") * 100.0, 2).alias("availability_pct"),
        half_up(F.col("_p") * 100.0, 2).alias("performance_pct"),
        half_up(F.col("_q") * 100.0, 2).alias("quality_pct"),
        half_up(product, 2).alias("oee_score"),
        rules.oee_class(product).alias("oee_class"),
        oee_weakest(F.col("_a"), F.col("_p"), F.col("_q")).alias("weakest_component"),
        F.col("reading_count").alias("actual_readings"),
        "anomaly_count", "avg_power_kw", "benchmark_power_kw", "avg_health_score",
        "min_health_score", "avg_temperature_c", "avg_vibration",
    )
    return _with_key(out, "oee_id", "event_date", "equipment_id")


# ----------------------------------------------------------------- M4

def daily_health(stg: DataFrame, p: Params = DEFAULT, daily: DataFrame | None = None) -> DataFrame:
    """Equipment-day health up to and including ``as_of``."""
    d = daily if daily is not None else daily_equipment(stg)
    return d.filter(F.col("event_date") <= F.lit(p.as_of)).select(
        "event_date", "equipment_id", "equipment_type",
        F.col("avg_health_score").alias("daily_avg_health"),
        F.col("min_health_score").alias("daily_min_health"),
        "reading_count", "anomaly_count",
    )


def _unit_window() -> Window:
    return Window.partitionBy("equipment_id").orderBy("event_date", "equipment_type")


def health_lag(dh: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Health ``lag_span`` rows back and one row back; flags the last row.

    One window spec (one sort) serves both lags and the latest-row flag.
    """
    w = _unit_window()
    return dh.select(
        "*",
        F.lag("daily_avg_health", p.lag_span).over(w).alias("health_7d_ago"),
        F.lag("daily_avg_health", 1).over(w).alias("health_yesterday"),
        F.lead("event_date", 1).over(w).isNull().alias("_is_latest"),
    )


def latest_per_equipment(lagged: DataFrame) -> DataFrame:
    """Newest day per equipment."""
    return lagged.filter(F.col("_is_latest")).drop("_is_latest")


def decline_columns(now: Column, back: Column, p: Params = DEFAULT) -> tuple[Column, Column]:
    """M4d: (average daily decline, days to failure)."""
    drop = back - now
    span = float(p.lag_span)
    decline = half_up(F.when(back.isNull(), F.lit(0.0)).otherwise(drop / span), 4)
    days = half_up(
        F.when(back.isNull() | (drop <= 0), F.lit(None).cast("double"))
        .when(now <= p.critical_health, F.lit(0.0))
        .otherwise((now - F.lit(p.critical_health)) / nullif(drop / span, 0)), 1)
    return decline, days


def failure_date(as_of: Column, days: Column) -> Column:
    """M4e: as-of date plus days rounded half away from zero."""
    return F.when(days.isNotNull() & (days >= 0), F.date_add(as_of, round_to_int(days)))


def fact_forecast(stg: DataFrame, p: Params = DEFAULT, daily: DataFrame | None = None) -> DataFrame:
    """M4: latest forecast per equipment as of ``p.as_of``."""
    latest = latest_per_equipment(health_lag(daily_health(stg, p, daily), p))
    now, back = F.col("daily_avg_health"), F.col("health_7d_ago")
    decline, days = decline_columns(now, back, p)
    calc = latest.select(
        F.col("event_date").alias("forecast_as_of_date"), "equipment_id", "equipment_type",
        now.alias("current_health_score"), F.col("daily_min_health").alias("current_min_health"),
        "health_7d_ago", half_up(now - back, 2).alias("health_change_7d"),
        decline.alias("avg_daily_decline"), days.alias("days_to_failure"),
        "reading_count", "anomaly_count",
    )
    level, action = rules.urgency_columns(F.col("current_health_score"), F.col("days_to_failure"),
                                          p.critical_health)
    out = calc.select(
        "forecast_as_of_date", "equipment_id", "equipment_type", "current_health_score",
        "current_min_health", "health_7d_ago", "health_change_7d", "avg_daily_decline",
        "days_to_failure",
        failure_date(F.col("forecast_as_of_date"), F.col("days_to_failure")).alias("predicted_failure_date"),
        level.alias("urgency_level"), action.alias("recommended_action"),
        "reading_count", "anomaly_count",
    )
    return _with_key(out, "forecast_id", "forecast_as_of_date", "equipment_id")


def urgency_order(forecast: DataFrame) -> DataFrame:
    """M4g: most urgent first, then fewest days (NULLs last)."""
    return (forecast.withColumn("urgency_rank", rules.urgency_rank(F.col("urgency_level")))
            .orderBy("urgency_rank", F.col("days_to_failure").asc_nulls_last(), "equipment_id"))


def forecast_ols(stg: DataFrame, p: Params = DEFAULT, daily: DataFrame | None = None) -> DataFrame:
    """M4h: least-squares health slope over the last ``lookback_days`` calendar days."""
    dh = daily_health(stg, p, daily).filter(
        F.col("event_date") > F.date_sub(F.lit(p.as_of), p.lookback_days))
    x = F.datediff(F.col("event_date"), F.lit(p.as_of)).cast("double")
    fit = dh.groupBy("equipment_id").agg(
        F.regr_slope(F.col("daily_avg_health"), x).alias("_slope"),
        F.count(F.lit(1)).alias("days_used"),
        F.max_by("daily_avg_health", "event_date").alias("current_health_score"),
    )
    decline = -F.col("_slope")
    now = F.col("current_health_score")
    days = (F.when(decline.isNull() | (decline <= 0), F.lit(None).cast("double"))
            .when(now <= p.critical_health, F.lit(0.0))
            .otherwise((now - F.lit(p.critical_health)) / decline))
    return fit.select("equipment_id", "days_used", "current_health_score",
                      half_up(decline, 4).alias("ols_daily_decline"),
                      half_up(days, 1).alias("ols_days_to_failure"))


def health_day_change(stg: DataFrame, p: Params = DEFAULT, daily: DataFrame | None = None) -> DataFrame:
    """M4i: day-over-day change of daily average health."""
    lagged = health_lag(daily_health(stg, p, daily), p)
    return lagged.select("event_date", "equipment_id", "daily_avg_health", "health_yesterday",
                         half_up(F.col("daily_avg_health") - F.col("health_yesterday"), 2)
                         .alias("health_change_1d"))
