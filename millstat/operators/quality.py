"""Data-quality rules (D1-D7) as Spark jobs.

Each rule returns rows of (rule, severity, failures, passed). Rules on one
table are evaluated in a single aggregate pass (conditional counts) and
turned into rows with ``unpivot``; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as rule_tables
from ..params import DEFAULT, Params

RESULT_COLUMNS = ["rule", "severity", "failures", "passed"]

# Accepted values of the categorical mart columns.
ACCEPTED = {
    "risk_level": ["CRITICAL", "WARNING", "WATCH", "NORMAL"],
    "oee_class": ["WORLD CLASS", "GOOD", "FAIR", "POOR"],
    "urgency_level": ["CRITICAL NOW", "STABLE", "CRITICAL", "HIGH", "MEDIUM", "LOW"],
    "equipment_type": ["Motor", "ConveyorBelt", "Chiller"],
}


def _rows(df: DataFrame, counts: dict[str, Column], severity: dict[str, str] | None = None) -> DataFrame:
    """One pass of conditional counts -> one result row per rule."""
    severity = severity or {}
    names = list(counts)
    wide = df.agg(*[c.cast("long").alias(f"r{i}") for i, c in enumerate(counts.values())])
    long = wide.unpivot([], [f"r{i}" for i in range(len(names))], "_slot", "failures")
    rule = rule_tables.chain([(F.col("_slot") == f"r{i}", n) for i, n in enumerate(names)], None)
    sev = rule_tables.chain([(F.col("_slot") == f"r{i}", severity.get(n, "error"))
                             for i, n in enumerate(names)], "error")
    return long.select(rule.alias("rule"), sev.alias("severity"), "failures",
                       (F.col("failures") == 0).alias("passed"))


def _nulls(table: str, columns: tuple[str, ...]) -> dict[str, Column]:
    return {f"not_null:{table}.{c}": F.count_if(F.col(c).isNull()) for c in columns}


def _outside(table: str, column: str) -> dict[str, Column]:
    return {f"accepted_values:{table}.{column}": F.count_if(~F.col(column).isin(ACCEPTED[column]))}


RAW_KEYS = ("timestamp", "equipment_id")
STG_KEYS = ("sensor_id", "event_timestamp", "equipment_id")


def dq_not_null(raw: DataFrame, stg: DataFrame) -> DataFrame:
    """NULL counts of the key columns of raw and staged readings."""
    return _rows(raw, _nulls("raw", RAW_KEYS)).unionByName(_rows(stg, _nulls("stg", STG_KEYS)))


def dq_unique(stg: DataFrame) -> DataFrame:
    """Staged sensor_id is unique (failures = duplicated key values)."""
    dup = stg.groupBy("sensor_id").count().filter(F.col("count") > 1)
    return _rows(dup, {"unique:stg.sensor_id": F.count(F.lit(1))})


def _accepted_marts(alerts: DataFrame, oee: DataFrame, forecast: DataFrame) -> DataFrame:
    return (_rows(alerts, _outside("alert", "risk_level")).unionByName(_rows(oee, _outside("oee", "oee_class")))
            .unionByName(_rows(forecast, _outside("forecast", "urgency_level"))))


def dq_accepted_values(stg: DataFrame, alerts: DataFrame, oee: DataFrame, forecast: DataFrame) -> DataFrame:
    """D3: categorical columns stay within their accepted set (NULL not counted)."""
    return _rows(stg, _outside("stg", "equipment_type")).unionByName(_accepted_marts(alerts, oee, forecast))


def dq_relationships(stg: DataFrame, energy: DataFrame, alerts: DataFrame) -> DataFrame:
    """Every mart row points at staged readings of the same unit and period."""
    # one pass over the readings: the (hour, unit) set, then days from it
    stg_hours = stg.select("event_hour", "event_date", "equipment_id").distinct()
    stg_days = stg_hours.select("event_date", "equipment_id").distinct()
    orphan_days = alerts.join(stg_days, ["event_date", "equipment_id"], "left_anti")
    orphan_hours = energy.join(stg_hours, ["event_hour", "equipment_id"], "left_anti")
    return (_rows(orphan_days, {"relationships:alert->stg": F.count(F.lit(1))})
            .unionByName(_rows(orphan_hours, {"relationships:energy->stg": F.count(F.lit(1))})))


def dq_energy_rules(energy: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Documented rules of the energy mart."""
    metrics = ["total_power_kwh", "avg_power_kw", "peak_power_kw", "avg_temperature_c",
               "max_temperature_c", "avg_vibration", "max_vibration", "avg_health_score",
               "min_health_score", "anomaly_count", "reading_count"]
    any_null = F.lit(False)
    for m in metrics:
        any_null = any_null | F.col(m).isNull()
    t, h = F.col("avg_temperature_c"), F.col("min_health_score")
    counts = {
        "energy:not_null": F.count_if(any_null),
        "energy:positive_energy": F.count_if(F.col("total_power_kwh") <= 0),
        "energy:avg_temp_range": F.count_if((t < -50) | (t > 100)),
        "energy:min_health_range": F.count_if((h < 0) | (h > 100)),
        "energy:reading_count_60": F.count_if(F.col("reading_count") != 60),
    }
    return _rows(energy, counts, {"energy:reading_count_60": "warn",
                                  "energy:positive_energy": "warn"})


PIECE = 24 * 31  #: hours that one step of the expansion makes of a gap at most


def missing_ranges(energy: DataFrame, since=None, until=None) -> DataFrame:
    """D7 as ranges: per gap between a unit's hours its first and last missing hour and their number.

    A gap scan: each unit's hours in order, the next hour by ``lead``. One shuffle
    by unit; a unit holds at most one row per hour (and type), so the window is
    bounded by the time span, not by the number of readings. ``since`` and ``until``
    bound the plausible hours (both included): rows outside them, of a broken clock say, open no gap.
    """
    hours = energy.select("equipment_id", "event_hour")
    if since is not None:
        hours = hours.where(F.col("event_hour") >= F.lit(str(since)).cast("timestamp_ntz"))
    if until is not None:
        hours = hours.where(F.col("event_hour") <= F.lit(str(until)).cast("timestamp_ntz"))
    w = Window.partitionBy("equipment_id").orderBy("event_hour")
    h, nxt = F.col("event_hour"), F.col("_next")
    # by days and hours of the day: no session zone takes part
    steps = F.datediff(F.to_date(nxt), F.to_date(h)).cast("long") * 24 + F.hour(nxt) - F.hour(h)
    one_hour = F.expr("INTERVAL 1 HOUR")
    return (hours.withColumn("_next", F.lead("event_hour").over(w)).withColumn("_steps", steps).where("_steps > 1")
            .select("equipment_id", (h + one_hour).alias("first_hour"), (nxt - one_hour).alias("last_hour"),
                    (F.col("_steps") - 1).alias("hours")))


def missing_hours(energy: DataFrame, since=None, until=None) -> DataFrame:
    """Equipment-hours between a unit's first and last hour with no mart row.

    The ranges cut into pieces of at most ``PIECE`` hours, then expanded piece by piece:
    a gap of a century makes many rows, but never one large array.
    """
    pieces = missing_ranges(energy, since, until).select(
        "equipment_id", "first_hour", "hours",
        F.explode(F.sequence(F.lit(0), ((F.col("hours") - 1) / PIECE).cast("int"))).alias("_piece"))
    left = F.col("hours").cast("int") - F.col("_piece") * PIECE
    steps = pieces.select("equipment_id", "first_hour", "_piece", F.explode(
        F.sequence(F.lit(0), F.least(left, F.lit(PIECE)) - 1)).alias("_step"))
    return steps.select("equipment_id", (F.col("first_hour") + F.make_dt_interval(
        hours=F.col("_piece") * PIECE + F.col("_step"))).alias("event_hour"))


def dq_missing_hours(energy: DataFrame) -> DataFrame:
    return _rows(missing_ranges(energy), {"completeness:energy.hours": F.coalesce(F.sum("hours"), F.lit(0))},
                 {"completeness:energy.hours": "warn"})


def dq_report(raw: DataFrame, stg: DataFrame, energy: DataFrame, alerts: DataFrame,
              oee: DataFrame, forecast: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Every rule stacked in one result.

    All counts over one table are one conditional aggregate, so one read; besides
    these, uniqueness, relationships and gaps group the rows by other keys and read theirs.
    """
    parts = [_rows(raw, _nulls("raw", RAW_KEYS)), _rows(stg, _nulls("stg", STG_KEYS) | _outside("stg", "equipment_type")),
             dq_unique(stg), _accepted_marts(alerts, oee, forecast),
             dq_relationships(stg, energy, alerts), dq_energy_rules(energy, p),
             dq_missing_hours(energy)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
