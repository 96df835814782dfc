"""Maintenance report queries (R1-R12) over the alert and forecast marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import exact_avg, half_up, nullif
from ..params import DEFAULT, Params
from .filters import page_filter

OPEN_RISKS = ["CRITICAL", "WARNING"]


def _since(p: Params, days: int | None = None):
    return F.date_sub(F.lit(p.as_of), p.lookback_days if days is None else days)


def open_alerts(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """CRITICAL and WARNING days, newest first (risk text descending)."""
    return (alerts.filter(F.col("risk_level").isin(OPEN_RISKS)).select(
        "event_date", "equipment_id", "equipment_type", "risk_level",
        F.col("min_health_score").alias("lowest_health"), "recommended_action",
    ).orderBy(F.col("event_date").desc(), F.col("risk_level").desc(), "equipment_id"))


def open_alerts_today(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """R1 variant: open alerts of the reporting day only."""
    return (alerts.filter(F.col("risk_level").isin(OPEN_RISKS) & (F.col("event_date") == F.lit(p.as_of)))
            .select("equipment_id", "risk_level", "min_health_score", "recommended_action"))


def health_trend(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """R2: daily health per unit over the last days."""
    return (alerts.filter(F.col("event_date") >= _since(p)).select(
        "event_date", "equipment_id", "equipment_type", "avg_health_score", "min_health_score",
    ).orderBy("equipment_id", "event_date"))


def risk_distribution(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Equipment-days per risk level and their share of all days."""
    total = alerts.agg(F.count(F.lit(1))).scalar()
    return (alerts.groupBy("risk_level").agg(F.count(F.lit(1)).alias("record_count"))
            .select("risk_level", "record_count",
                    half_up(F.col("record_count") * 100.0 / total, 2).alias("pct_of_total"))
            .orderBy(F.col("record_count").desc(), "risk_level"))


def risk_distribution_last_day(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """R3 variant: risk counts since the day before the reporting date."""
    return (alerts.filter(F.col("event_date") >= _since(p, 1)).groupBy("risk_level")
            .agg(F.count(F.lit(1)).alias("alert_count")).orderBy("risk_level"))


def risk_vs_maxima(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Sensor maxima per risk level."""
    return (alerts.groupBy("risk_level").agg(
        half_up(exact_avg("min_health_score", 2), 2).alias("avg_min_health"),
        half_up(exact_avg("max_temperature_c", 2), 2).alias("avg_max_temp_c"),
        half_up(exact_avg("max_vibration", 4), 4).alias("avg_max_vibration"),
        half_up(exact_avg("max_power_kw", 2), 2).alias("avg_max_power_kw"),
        F.sum("total_anomalies").cast("long").alias("total_anomalies"),
    ).orderBy("avg_min_health", "risk_level"))


def anomaly_leaderboard(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Anomaly share per unit over all days."""
    a = F.sum("total_anomalies").cast("long")
    r = F.sum("total_readings").cast("long")
    return (alerts.groupBy("equipment_id", "equipment_type").agg(
        a.alias("total_anomalies_recorded"),
        r.alias("total_readings_taken"),
        half_up(a * F.lit(100.0) / nullif(r, 0), 2).alias("overall_anomaly_rate_pct"),
        F.min("min_health_score").alias("historic_lowest_health"),
    ).orderBy(F.col("overall_anomaly_rate_pct").desc_nulls_first(), "equipment_id"))


def mart_sample_alerts(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per risk level count, mean lowest health and anomalies."""
    return (alerts.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("record_count"),
        half_up(exact_avg("min_health_score", 2), 2).alias("avg_min_health"),
        F.sum("total_anomalies").cast("long").alias("total_anomalies"),
    ).orderBy(F.col("record_count").desc(), "risk_level"))


def failure_timeline(forecast: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Units with a predicted failure, soonest first."""
    d = F.col("days_to_failure")
    return (forecast.filter(d.isNotNull() & (d > 0)).select(
        "equipment_id", "urgency_level", F.col("current_health_score").alias("current_health"),
        d.alias("estimated_days_remaining"), "predicted_failure_date", "recommended_action",
    ).orderBy("estimated_days_remaining", "equipment_id"))


def anomaly_heatmap(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Anomalous readings per unit and hour of day (long form)."""
    return (stg.filter((F.col("is_anomaly") == 1) & (F.col("event_date") >= _since(p)))
            .groupBy("equipment_id", F.hour("event_timestamp").alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("anomaly_count")))


def anomaly_heatmap_pivot(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """R8 pivoted: one row per unit, one column per hour 0-23 (0 when none).

    The pivot values are fixed, so Spark needs no extra job to find them.
    """
    hours = list(range(24))
    long = (stg.filter((F.col("is_anomaly") == 1) & (F.col("event_date") >= _since(p)))
            .select("equipment_id", F.hour("event_timestamp").alias("hour_of_day")))
    wide = long.groupBy("equipment_id").pivot("hour_of_day", hours).count()
    return wide.select("equipment_id", *[
        F.coalesce(F.col(str(h)), F.lit(0)).cast("long").alias(f"h{h:02d}") for h in hours])


def current_health(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Lowest health ever and last reporting day per unit."""
    return (alerts.groupBy("equipment_id").agg(
        F.min("min_health_score").alias("current_health"),
        F.max("event_date").alias("last_reading"),
    ).orderBy("current_health", "equipment_id"))


def kpi_targets(alerts: DataFrame, forecast: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Maintenance KPIs against their goals, one row per KPI."""
    today = alerts.filter(F.col("event_date") == F.lit(p.as_of))
    week = alerts.filter(F.col("event_date") >= _since(p))
    counts = today.agg(
        F.count_if(F.col("risk_level") == "CRITICAL").cast("double").alias("critical_alerts"),
        F.count_if(F.col("risk_level") == "WARNING").cast("double").alias("high_alerts"),
    )
    weekly = week.agg(
        half_up(exact_avg("avg_health_score", 2), 2).alias("average_health"),
        F.countDistinct(F.when(F.col("min_health_score") < 30, F.col("equipment_id")))
        .cast("double").alias("units_below_30"),
    )
    mttf = forecast.agg(half_up(exact_avg("days_to_failure", 1), 2).alias("mean_days_to_failure"))
    wide = counts.select(
        "*",
        weekly.select("average_health").scalar().alias("average_health"),
        weekly.select("units_below_30").scalar().alias("units_below_30"),
        mttf.scalar().alias("mean_days_to_failure"),
    )
    long = wide.unpivot([], ["critical_alerts", "high_alerts", "average_health", "units_below_30",
                             "mean_days_to_failure"], "kpi", "value")
    k, v = F.col("kpi"), F.col("value")
    goal = rules.chain([(k == "critical_alerts", "= 0"), (k == "high_alerts", "< 5"),
                        (k == "average_health", "> 70"), (k == "units_below_30", "= 0")], "> 14")
    met = rules.chain([(k == "critical_alerts", v == 0), (k == "high_alerts", v < 5),
                       (k == "average_health", v > 70), (k == "units_below_30", v == 0)], v > 14)
    return long.select("kpi", "value", goal.alias("goal"), F.coalesce(met, F.lit(False)).alias("met"))


def health_by_range(alerts: DataFrame, low: float = 0.0, high: float = 100.0, types=None, units=None, risks=None,
                    start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Page filter of the alert mart (health range, type, unit, risk, dates); only what is given filters."""
    return page_filter(alerts, start, end, {"min_health_score": (low, high)}, equipment_type=types, equipment_id=units,
                       risk_level=risks).select("alert_id", "event_date", "equipment_id", "equipment_type",
                                                "min_health_score", "risk_level")


def cause_rules(stg: DataFrame, forecast: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Maintenance action from combined symptoms of a reading (all valid ones).

    The forecast has one row per unit; the join is on unit id, and AQE
    either broadcasts it or splits a hot unit's partition (skew join).
    """
    reason = F.coalesce(F.col("anomaly_reason"), F.lit(""))
    decline = F.col("avg_daily_decline")
    cases = [
        reason.contains("vibration_spike") & (decline > 0),
        reason.contains("temperature_spike") & reason.contains("power_consumption_spike"),
        decline >= 2,
        F.col("is_anomaly") == 1,
    ]
    sev = rules.chain([(c, a[0]) for c, a in zip(cases, rules.CAUSE_ACTIONS)], rules.CAUSE_DEFAULT[0])
    act = rules.chain([(c, a[1]) for c, a in zip(cases, rules.CAUSE_ACTIONS)], rules.CAUSE_DEFAULT[1])
    readings = stg.filter(~F.col("is_out_of_range")).select(
        "sensor_id", "equipment_id", "event_timestamp", "anomaly_reason", "is_anomaly")
    fc = forecast.select("equipment_id", "avg_daily_decline")
    return readings.join(fc, "equipment_id", "left").select(
        "sensor_id", "equipment_id", "event_timestamp", "anomaly_reason", "avg_daily_decline",
        F.coalesce(sev, F.lit(rules.CAUSE_DEFAULT[0])).alias("cause_severity"),
        F.coalesce(act, F.lit(rules.CAUSE_DEFAULT[1])).alias("cause_action"))


def export_alerts(alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Work-order export - open alerts since the day before, empty work order."""
    return (alerts.filter(F.col("risk_level").isin(OPEN_RISKS) & (F.col("event_date") >= _since(p, 1)))
            .select("alert_id", "equipment_id", "risk_level", "recommended_action", "event_date",
                    F.lit(None).cast("string").alias("work_order_id"))
            .orderBy(F.col("risk_level").desc(), F.col("event_date").desc(), "equipment_id"))
