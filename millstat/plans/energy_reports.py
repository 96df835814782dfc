"""Energy report queries (Q1-Q15) over the hourly energy mart.

Every "last N days" filter is given an explicit reporting date and is put
on both ``event_hour`` and ``event_date``: the second predicate prunes
date partitions when the mart is stored partitioned by day. Totals that
other rows are divided by are uncorrelated scalar subqueries, run once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum, half_up, nullif
from ..params import DEFAULT, Params


def since(p: Params) -> Column:
    return F.date_sub(F.lit(p.as_of), p.lookback_days)


def last_days(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    start = since(p)
    return energy.filter((F.col("event_date") >= start) &
                         (F.col("event_hour") >= start.cast("timestamp_ntz")))


def _kwh(digits: int = 2) -> Column:
    return half_up(exact_sum("total_power_kwh", 2), digits)


def energy_by_type(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q1: energy per equipment type over the last days, largest first."""
    return (last_days(energy, p).groupBy("equipment_type").agg(
        F.count(F.lit(1)).alias("hourly_readings"),
        _kwh().alias("total_kwh"),
        half_up(exact_avg("total_power_kwh", 2), 2).alias("avg_kwh_per_hour"),
        half_up(F.max("total_power_kwh"), 2).alias("peak_kwh"),
        half_up(F.min("total_power_kwh"), 2).alias("min_kwh"),
    ).orderBy(F.col("total_kwh").desc(), "equipment_type"))


def hourly_trend(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q2: factory totals per hour with the number of reporting units.

    Two-level aggregate instead of a distinct count: exact scaled-long sums
    per (hour, unit), then per hour with a plain count of units. Spark plans
    a distinct count next to other aggregates with an Expand that doubles
    every row; here the first level only shrinks the data.
    """
    per_unit = last_days(energy, p).groupBy("event_hour", "equipment_id").agg(
        F.sum(F.rint(F.col("total_power_kwh") * 100.0).cast("long")).alias("_kwh100"),
        F.sum(F.rint(F.col("avg_temperature_c") * 100.0).cast("long")).alias("_temp100"),
        F.count("avg_temperature_c").alias("_temp_n"),
    )
    return (per_unit.groupBy("event_hour").agg(
        half_up(F.sum("_kwh100").cast("double") / 100.0, 2).alias("hourly_total_kwh"),
        F.count(F.lit(1)).alias("equipment_count"),
        half_up(F.sum("_temp100").cast("double") / 100.0 / F.sum("_temp_n"), 1).alias("avg_factory_temp"),
    ).orderBy("event_hour"))


def energy_by_equipment(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q3: per unit energy, temperature and vibration."""
    return (last_days(energy, p).groupBy("equipment_id", "equipment_type").agg(
        F.count(F.lit(1)).alias("hourly_readings"),
        _kwh().alias("total_kwh"),
        half_up(exact_avg("total_power_kwh", 2), 2).alias("avg_kwh_per_hour"),
        half_up(exact_sum("total_power_kwh", 2) / F.count(F.lit(1)), 2).alias("kwh_per_reading"),
        half_up(exact_avg("avg_temperature_c", 2), 2).alias("avg_operating_temp"),
        half_up(exact_avg("max_vibration", 4), 2).alias("avg_vibration"),
    ).orderBy(F.col("total_kwh").desc(), "equipment_id"))


def peak_hour(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q4: energy by hour of day, highest average first."""
    return (last_days(energy, p).groupBy(F.hour("event_hour").alias("hour_of_day")).agg(
        half_up(exact_avg("total_power_kwh", 2), 2).alias("avg_kwh"),
        F.count(F.lit(1)).alias("samples"),
        half_up(F.max("total_power_kwh"), 2).alias("peak_kwh"),
        _kwh().alias("total_kwh"),
    ).orderBy(F.col("avg_kwh").desc(), "hour_of_day"))


def peak_hour_top1(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q4 top-1 variant: the single busiest hour of day."""
    return peak_hour(energy, p).select("hour_of_day", "avg_kwh").limit(1)


def temp_efficiency(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q5: energy per degree (warm hours only), top N by ratio."""
    t = F.col("avg_temperature_c")
    return (last_days(energy, p).filter(t > 0).select(
        "equipment_id", "equipment_type", "event_hour",
        half_up(t, 2).alias("temp_celsius"),
        half_up("total_power_kwh", 2).alias("kwh"),
        half_up(F.col("total_power_kwh") / nullif(t + 1, 0), 2).alias("efficiency_ratio"),
    ).orderBy(F.col("efficiency_ratio").desc_nulls_last(), "equipment_id", "event_hour")
        .limit(p.top_efficiency))


def daily_budget(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q6: daily energy against a budget."""
    total = exact_sum("total_power_kwh", 2)
    budget = F.lit(float(p.daily_budget))
    return (last_days(energy, p).groupBy("event_date").agg(
        half_up(total, 2).alias("daily_kwh"),
        half_up(total - budget, 2).alias("variance_kwh"),
        F.when(total > budget, "OVER").otherwise("WITHIN").alias("budget_status"),
    ).select("event_date", "daily_kwh", budget.alias("daily_budget_kwh"), "variance_kwh",
             "budget_status").orderBy(F.col("event_date").desc()))


def high_power(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q7: anomalous hours with the highest energy, against the all-time mean."""
    overall = energy.agg(exact_avg("total_power_kwh", 2)).scalar()
    return (last_days(energy, p).filter(F.col("anomaly_count") > 0).select(
        "equipment_id", "equipment_type", "event_hour", "total_power_kwh",
        "avg_temperature_c", "anomaly_count",
        half_up(F.col("total_power_kwh") / overall, 2).alias("deviation_ratio"),
    ).orderBy(F.col("total_power_kwh").desc(), "equipment_id", "event_hour")
        .limit(p.top_high_power))


def total_energy(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q8: scorecard total, as coded and as documented (kW-minutes / 60)."""
    total = exact_sum("total_power_kwh", 2)
    return last_days(energy, p).agg(
        half_up(total, 2).alias("total_kwh"),
        half_up(total / 60.0, 2).alias("total_energy_kwh"),
    )


def temp_power_scatter(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q9: points for a temperature / energy scatter plot."""
    return last_days(energy, p).select("equipment_id", "event_hour", "avg_temperature_c",
                                       "total_power_kwh", "equipment_type")


def mart_sample_energy(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q10: all-time per-type summary."""
    return (energy.groupBy("equipment_type").agg(
        F.count(F.lit(1)).alias("hourly_readings"),
        _kwh().alias("total_kwh"),
        half_up(exact_avg("avg_power_kw", 2), 2).alias("avg_power_kw"),
        half_up(exact_avg("avg_temperature_c", 2), 2).alias("avg_temp"),
    ).orderBy(F.col("total_kwh").desc(), "equipment_type"))


def overheating(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q11: hours whose average temperature is above the limit."""
    return energy.filter(F.col("avg_temperature_c") > p.overheat_temp).select(
        "fact_id", "event_hour", "equipment_id", "equipment_type", "avg_temperature_c")


def anomaly_hours(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q12: hours with at least one anomalous reading."""
    return energy.filter(F.col("anomaly_count") > 0).select(
        "fact_id", "event_hour", "equipment_id", "anomaly_count", "reading_count")


def period_rollup(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q13: week and month totals per type in one pass over the mart."""
    periods = F.explode(F.array(
        F.struct(F.lit("week").alias("period"),
                 F.to_date(F.date_trunc("week", "event_hour")).alias("period_start")),
        F.struct(F.lit("month").alias("period"),
                 F.to_date(F.date_trunc("month", "event_hour")).alias("period_start")),
    )).alias("_p")
    return (energy.select(periods, "equipment_type", "total_power_kwh")
            .select("_p.period", "_p.period_start", "equipment_type", "total_power_kwh")
            .groupBy("period", "period_start", "equipment_type").agg(
                F.count(F.lit(1)).alias("hours"),
                _kwh().alias("total_kwh"),
            ))


def energy_health_join(energy: DataFrame, alerts: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q14: daily energy next to the daily alert row of the same unit.

    Both sides are grouped on the join keys, so the join reuses their hash
    partitioning (or AQE broadcasts the smaller side).
    """
    keys = ["event_date", "equipment_id", "equipment_type"]
    daily = energy.groupBy(*keys).agg(_kwh().alias("daily_kwh"),
                                      F.sum("anomaly_count").cast("long").alias("anomaly_hours_sum"))
    return daily.join(alerts.select(*keys, "avg_health_score", "min_health_score", "risk_level",
                                    "total_anomalies"), on=keys, how="inner")


def energy_share(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q15: each type's percent of total energy."""
    recent = last_days(energy, p)
    total = recent.agg(exact_sum("total_power_kwh", 2)).scalar()
    return (recent.groupBy("equipment_type").agg(exact_sum("total_power_kwh", 2).alias("_kwh"))
            .select("equipment_type", half_up("_kwh", 2).alias("total_kwh"),
                    half_up(F.col("_kwh") * 100.0 / total, 2).alias("pct_of_total")))
