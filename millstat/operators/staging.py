"""Staging operators (S1-S10): raw readings -> one clean row per reading.

All steps are narrow column expressions except the dedup (one shuffle on
(timestamp, equipment_id)). ``row_number() == 1`` lets Spark put a partial
WindowGroupLimit before that shuffle, so a heavily duplicated reading sends
at most one row per map task across the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.numeric import half_up
from ..params import DEFAULT, Params

DEDUP_KEYS = ("timestamp", "equipment_id")

STAGED_COLUMNS = [
    "sensor_id", "event_timestamp", "event_hour", "event_date", "loaded_at",
    "equipment_id", "equipment_type", "temperature_celsius", "vibration_mm_s",
    "power_kw", "health_score", "is_anomaly", "anomaly_reason", "is_out_of_range",
]


def not_null_filter(raw: DataFrame, keys=DEDUP_KEYS) -> DataFrame:
    """Drop readings with a NULL key column (reaches the scan filter)."""
    return raw.dropna(subset=list(keys))


def dedup_latest(raw: DataFrame, keys=DEDUP_KEYS, tie_breakers: list[Column] | None = None,
                 load_col: str = "load_timestamp") -> DataFrame:
    """Keep the newest load of each key.

    A NULL load time counts as newest (NULLs sort high on a descending
    order in the warehouse). ``tie_breakers`` make equal load times
    deterministic.
    """
    order = [F.col(load_col).desc_nulls_first()] + list(tie_breakers or [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return (raw.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def out_of_range(temp: Column, vib: Column, power: Column, health: Column,
                 p: Params = DEFAULT) -> Column:
    """S3: physical-limit flag; a NULL reading is never out of range."""
    lim = p.limits
    conds = [
        (temp < lim.temp_min) | (temp > lim.temp_max),
        (vib < lim.vib_min) | (vib > lim.vib_max),
        power < lim.power_min,
        (health < lim.health_min) | (health > lim.health_max),
    ]
    out = F.lit(False)
    for c in conds:
        out = out | F.coalesce(c, F.lit(False))
    return out


def range_flags(raw: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """S3 on raw readings: adds ``is_out_of_range``."""
    return raw.withColumn("is_out_of_range", out_of_range(
        F.col("temperature"), F.col("vibration"), F.col("power_consumption"),
        F.col("health_score"), p))


def rounded(raw: DataFrame) -> list[Column]:
    """Cleaned readings (half away from zero)."""
    return [
        half_up("temperature", 2).alias("temperature_celsius"),
        half_up("vibration", 4).alias("vibration_mm_s"),
        half_up("power_consumption", 2).alias("power_kw"),
        half_up("health_score", 2).alias("health_score"),
    ]


def time_parts() -> list[Column]:
    """Event hour (timestamp without zone) and event date."""
    return [
        F.date_trunc("hour", F.col("timestamp")).cast("timestamp_ntz").alias("event_hour"),
        F.to_date(F.col("timestamp")).alias("event_date"),
    ]


def stage(raw: DataFrame, p: Params = DEFAULT, tie_breakers: list[Column] | None = None) -> DataFrame:
    """The whole staging contract (S1-S6) as one lazy plan."""
    if tie_breakers is None and "event_id" in raw.columns:
        tie_breakers = [F.col("event_id").desc()]
    latest = dedup_latest(not_null_filter(raw), tie_breakers=tie_breakers)
    flagged = range_flags(latest, p)
    return flagged.select(
        surrogate_key(flagged, "timestamp", "equipment_id").alias("sensor_id"),
        F.col("timestamp").alias("event_timestamp"),
        *time_parts(),
        F.col("load_timestamp").alias("loaded_at"),
        "equipment_id", "equipment_type",
        *rounded(flagged),
        "is_anomaly", "anomaly_reason", "is_out_of_range",
    )


def valid_only(stg: DataFrame) -> DataFrame:
    """Marts read only in-range readings."""
    return stg.filter(~F.col("is_out_of_range"))


def null_out_of_range(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Alternative policy - a reading outside its bounds becomes NULL."""
    lim = p.limits

    def keep(c: str, lo, hi) -> Column:
        x = F.col(c)
        ok = x >= lo if hi is None else x.between(lo, hi)
        return F.when(ok, x).alias(c)

    return stg.select(
        "sensor_id", "event_timestamp", "equipment_id",
        keep("temperature_celsius", lim.temp_min, p.null_temp_max),
        keep("vibration_mm_s", lim.vib_min, lim.vib_max),
        keep("power_kw", lim.power_min, None),
        keep("health_score", lim.health_min, lim.health_max),
    )


def quality_flag(stg: DataFrame) -> DataFrame:
    """Text quality flag per reading, first match wins."""
    flag = (F.when(F.col("temperature_celsius").isNull(), "missing_temperature")
            .when(F.col("vibration_mm_s").isNull(), "missing_vibration")
            .otherwise("valid"))
    return stg.select("sensor_id", "event_timestamp", "equipment_id", flag.alias("data_quality_flag"))
