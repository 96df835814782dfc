"""Anomaly and profiling operators.

Per-reading rules (A1-A6) are narrow projections that stay in one codegen
stage; the equipment spec is a fixed configuration, rendered as CASE
expressions, so no join is needed. Group profiles (A7-A9) are plain
aggregations with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import sqltext as sq
from ..functions.numeric import exact_sum, half_up
from ..params import DEFAULT, Params

# Normal behaviour and safe range per equipment type and sensor
# (mean, std, min, max), as in the reference's equipment configuration.
SPEC = {
    "Motor": {
        "temperature": (45.0, 5.0, 20.0, 80.0),
        "vibration": (2.5, 0.5, 0.0, 10.0),
        "power_consumption": (8.5, 1.0, 5.0, 15.0),
    },
    "ConveyorBelt": {
        "temperature": (40.0, 4.0, 20.0, 70.0),
        "vibration": (2.0, 0.4, 0.0, 8.0),
        "power_consumption": (6.0, 0.8, 3.0, 10.0),
    },
    "Chiller": {
        "temperature": (15.0, 3.0, 5.0, 45.0),
        "vibration": (1.5, 0.3, 0.0, 6.0),
        "power_consumption": (18.0, 2.0, 10.0, 30.0),
    },
}
SENSORS = ["temperature", "vibration", "power_consumption"]
_STAT = {"mean": 0, "std": 1, "min": 2, "max": 3}

# column names of the three sensors and health on raw and on staged rows
RAW_NAMES = {"temperature": "temperature", "vibration": "vibration",
             "power_consumption": "power_consumption", "health": "health_score"}
STG_NAMES = {"temperature": "temperature_celsius", "vibration": "vibration_mm_s",
             "power_consumption": "power_kw", "health": "health_score"}


def spec_value(etype: Column, sensor: str, stat: str, spec=None) -> Column:
    spec = spec or SPEC
    out = None
    for t, sensors in spec.items():
        v = F.lit(float(sensors[sensor][_STAT[stat]]))
        out = F.when(etype == t, v) if out is None else out.when(etype == t, v)
    return out


def _spec_sql(sensor: str, stat: str, spec=None) -> str:
    spec = spec or SPEC
    return sq.case("equipment_type", [(sq.quote(t), sq.dbl(v[sensor][_STAT[stat]])) for t, v in spec.items()])


def with_spec(df: DataFrame, spec=None) -> DataFrame:
    """Adds the type's mean/std/min/max of every sensor as columns ``_<stat>_<sensor>``.

    Each lookup is evaluated once per row; later expressions reference the
    columns instead of repeating the CASE over types.
    """
    return df.selectExpr("*", *[f"{_spec_sql(s, st, spec)} AS _{st}_{s}" for s in SENSORS for st in _STAT])


def drop_spec(df: DataFrame) -> DataFrame:
    return df.drop(*[f"_{st}_{s}" for s in SENSORS for st in _STAT])


def deviation(sensor: str, names=RAW_NAMES) -> Column:
    """abs z-score of one sensor (needs ``with_spec`` columns)."""
    return F.expr(_deviation_sql(sensor, names))


def _deviation_sql(sensor: str, names=RAW_NAMES) -> str:
    return f"(ABS({names[sensor]} - _mean_{sensor}) / _std_{sensor})"


def _threshold_sql(health: str, p: Params = DEFAULT) -> str:
    return (f"CASE WHEN {health} > 70 THEN {sq.dbl(p.spike_sigma_healthy)} "
            f"WHEN {health} > 50 THEN {sq.dbl(p.spike_sigma_degrading)} "
            f"ELSE {sq.dbl(p.spike_sigma_critical)} END")


def spike_threshold(health: Column, p: Params = DEFAULT) -> Column:
    return (F.when(health > 70, F.lit(p.spike_sigma_healthy))
            .when(health > 50, F.lit(p.spike_sigma_degrading))
            .otherwise(F.lit(p.spike_sigma_critical)))


def with_spikes(df: DataFrame, names=RAW_NAMES, p: Params = DEFAULT, spec=None) -> DataFrame:
    """Adds boolean ``_spike_<sensor>`` columns (NULL reading: never a spike)."""
    specced = with_spec(df, spec).selectExpr("*", f"{_threshold_sql(names['health'], p)} AS _thr")
    out = specced.selectExpr("*", *[f"coalesce({_deviation_sql(s, names)} > _thr, false) AS _spike_{s}"
                                    for s in SENSORS])
    return drop_spec(out).drop("_thr")


def anomaly_columns(spiked: DataFrame):
    """(is_anomaly int, anomaly_reason text) from ``with_spikes`` columns (A2)."""
    any_spike = " OR ".join(f"_spike_{s}" for s in SENSORS)
    reason = "concat_ws(', ', " + ", ".join(f"CASE WHEN _spike_{s} THEN '{s}_spike' END" for s in SENSORS) + ")"
    return (F.expr(f"CAST(CASE WHEN {any_spike} THEN 1 ELSE 0 END AS INT)"),
            F.expr(f"CASE WHEN {reason} = '' THEN CAST(NULL AS STRING) ELSE {reason} END"))


def drop_spikes(df: DataFrame) -> DataFrame:
    return df.drop(*[f"_spike_{s}" for s in SENSORS])


# ----------------------------------------------------------------- A1-A6

def sensor_deviation(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A1: per staged reading, |z| of each sensor (4 dp)."""
    z = with_spec(stg).select("sensor_id", "equipment_id", "equipment_type", "event_timestamp",
                              *[deviation(s, STG_NAMES).alias(f"_z_{s}") for s in SENSORS])
    return z.select("sensor_id", "equipment_id", "equipment_type", "event_timestamp",
                    *[half_up(f"_z_{s}", 4).alias(f"{s}_z") for s in SENSORS])


def anomaly_score(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A2: recomputed spike flag and reason list on staged readings."""
    spiked = with_spikes(stg, STG_NAMES, p)
    flag, reason = anomaly_columns(spiked)
    return spiked.select(
        "sensor_id", "equipment_id", "event_timestamp", "health_score",
        spike_threshold(F.col("health_score"), p).alias("spike_threshold"),
        flag.alias("detected_anomaly"), reason.alias("detected_reason"),
    )


def sensor_range_check(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A3: readings outside their type's safe min/max (NULL is not outside)."""
    specced = with_spec(stg)
    outs = {}
    for s in SENSORS:
        x = F.col(STG_NAMES[s])
        outs[s] = F.coalesce((x < F.col(f"_min_{s}")) | (x > F.col(f"_max_{s}")), F.lit(False))
    flagged = specced.select("sensor_id", "equipment_id", "event_timestamp",
                             *[outs[s].alias(f"_out_{s}") for s in SENSORS])
    outs = {s: F.col(f"_out_{s}") for s in SENSORS}
    listed = F.concat_ws(", ", *[F.when(outs[s], F.lit(s)) for s in SENSORS])
    return flagged.select(
        "sensor_id", "equipment_id", "event_timestamp",
        (outs[SENSORS[0]] | outs[SENSORS[1]] | outs[SENSORS[2]]).alias("out_of_spec"),
        F.when(listed == "", F.lit(None).cast("string")).otherwise(listed).alias("out_of_spec_sensors"),
    )


def health_band(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A4: health -> condition reason (NULL for healthy or unknown health)."""
    h = F.col("health_score")
    band = F.when(h.isNull(), F.lit(None).cast("string")).otherwise(rules.health_band(h))
    return stg.select("sensor_id", "equipment_id", "event_timestamp", "health_score",
                      band.alias("health_reason"))


def row_severity(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A5: row-level alerts - anomalous readings with health below 50."""
    h = F.col("health_score")
    return (stg.filter((F.col("is_anomaly") == 1) & (h < 50))
            .select("sensor_id", "event_timestamp", "equipment_id", "equipment_type",
                    "health_score", "anomaly_reason", rules.severity(h).alias("alert_severity")))


def correlated_spikes(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per unit, readings where two or more sensors spike together."""
    spiked = with_spikes(stg.select("equipment_id", "equipment_type", *STG_NAMES.values()), STG_NAMES, p)
    n_spikes = sum(F.col(f"_spike_{s}").cast("int") for s in SENSORS)
    marked = spiked
    agg = marked.groupBy("equipment_id", "equipment_type").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum(F.when(n_spikes >= 2, 1).otherwise(0)).cast("long").alias("correlated_readings"),
    )
    return agg.withColumn(
        "correlated_pct",
        half_up(F.col("correlated_readings") * F.lit(100.0) / F.col("readings"), 2))


# ----------------------------------------------------------------- A7-A9

def sensor_corr(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Pearson correlation of temperature and power per equipment type."""
    return stg.groupBy("equipment_type").agg(
        half_up(F.corr("temperature_celsius", "power_kw"), 4).alias("temp_power_corr"),
        F.count(F.lit(1)).alias("readings"),
    )


def dataset_profile(raw: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One-row profile of a reading set."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("timestamp").alias("first_reading"),
        F.max("timestamp").alias("last_reading"),
        F.countDistinct("equipment_id").alias("equipment_count"),
        half_up(F.sum("is_anomaly") * F.lit(100.0) / F.count("is_anomaly"), 2).alias("anomaly_rate_pct"),
    )


def decline_rate(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Observed health loss per day (least squares) and days from 100 to 0."""
    minute_of_day = F.hour("event_timestamp") * 60 + F.minute("event_timestamp")
    day = F.datediff(F.col("event_date"), F.lit(p.as_of)).cast("double") + minute_of_day / 1440.0
    fitted = stg.filter(F.col("health_score").isNotNull()).groupBy("equipment_id").agg(
        F.regr_slope(F.col("health_score"), day).alias("_slope"),
        F.count(F.lit(1)).alias("readings"),
    )
    loss = -F.col("_slope")
    return fitted.select(
        "equipment_id", "readings",
        half_up(loss, 4).alias("health_loss_per_day"),
        F.when(loss > 0, half_up(F.lit(100.0) / loss, 1)).alias("days_100_to_0"),
    )


__all__ = [
    "SPEC", "SENSORS", "RAW_NAMES", "STG_NAMES", "spec_value", "anomaly_columns", "with_spikes",
    "sensor_deviation", "anomaly_score", "sensor_range_check", "health_band", "row_severity",
    "correlated_spikes", "sensor_corr", "dataset_profile", "decline_rate", "exact_sum",
]
