"""OEE and forecast report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import exact_avg, exact_sum, half_up
from ..params import DEFAULT, Params

KPI_COLUMNS = {"oee": "oee_score", "availability": "availability_pct",
               "performance": "performance_pct", "quality": "quality_pct"}


def oee_kpis(oee: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """O1: average OEE and components."""
    return oee.agg(*[half_up(exact_avg(c, 2), 2).alias(f"avg_{k}") for k, c in KPI_COLUMNS.items()])


def world_class_machines(oee: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """O2: distinct units with at least one WORLD CLASS day."""
    return oee.agg(F.countDistinct(F.when(F.col("oee_class") == "WORLD CLASS", F.col("equipment_id")))
                   .alias("world_class_machines"))


def critical_risk_count(forecast: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """O3: units whose urgency is CRITICAL NOW or CRITICAL."""
    return forecast.agg(F.count_if(F.col("urgency_level").isin("CRITICAL NOW", "CRITICAL"))
                        .alias("machines_at_critical_risk"))


def days_to_failure_stats(forecast: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Mean and minimum days to failure over units that have one."""
    return forecast.agg(half_up(exact_avg("days_to_failure", 1), 2).alias("avg_days_to_failure"),
                        F.min("days_to_failure").alias("min_days_to_failure"))


def oee_by_equipment(oee: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Average OEE per unit."""
    return (oee.groupBy("equipment_id", "equipment_type")
            .agg(half_up(exact_avg("oee_score", 2), 2).alias("avg_oee_score"),
                 F.count(F.lit(1)).alias("days"))
            .orderBy(F.col("avg_oee_score").desc(), "equipment_id"))


def oee_trend(oee: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """O5 trend: OEE per unit and day with its components."""
    return oee.select("event_date", "equipment_id", "oee_score", "availability_pct",
                      "performance_pct", "quality_pct").orderBy("equipment_id", "event_date")


def kpi_status(oee: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Traffic-light band per KPI."""
    wide = oee_kpis(oee, p)
    long = wide.unpivot([], [f"avg_{k}" for k in KPI_COLUMNS], "kpi", "value")
    status = rules.chain([(F.col("kpi") == f"avg_{k}", rules.kpi_status(F.col("value"), k))
                          for k in KPI_COLUMNS], "RED")
    return long.select(F.regexp_replace("kpi", "^avg_", "").alias("kpi"), "value", status.alias("status"))


def executive_overview(energy: DataFrame, alerts: DataFrame, oee: DataFrame, forecast: DataFrame,
                       p: Params = DEFAULT) -> DataFrame:
    """One-row summary across all marts (each figure a scalar subquery)."""
    start = F.date_sub(F.lit(p.as_of), p.lookback_days)
    recent = energy.filter((F.col("event_date") >= start) & (F.col("event_hour") >= start.cast("timestamp_ntz")))
    base = recent.agg(half_up(exact_sum("total_power_kwh", 2), 2).alias("total_kwh_7d"))
    return base.select(
        "total_kwh_7d",
        oee.agg(half_up(exact_avg("oee_score", 2), 2)).scalar().alias("avg_oee_score"),
        alerts.filter(F.col("event_date") == F.lit(p.as_of))
        .agg(F.count_if(F.col("risk_level") == "CRITICAL")).scalar().alias("critical_alerts_today"),
        alerts.filter(F.col("event_date") >= start)
        .agg(half_up(exact_avg("avg_health_score", 2), 2)).scalar().alias("avg_health_7d"),
        forecast.agg(F.count_if(F.col("urgency_level").isin("CRITICAL NOW", "CRITICAL")))
        .scalar().alias("machines_at_critical_risk"),
        forecast.agg(F.count(F.lit(1))).scalar().alias("machines"),
    )
