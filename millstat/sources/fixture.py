"""Raw sensor readings derived from the driver table ``events``.

The reference ships a random simulator and no data; here every raw reading
is a deterministic function of one ``events`` row, so the Spark pipeline
and the SQL oracle see the same input (see FIXTURES.md section 2).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext as sq
from ..operators.anomaly import SPEC, anomaly_columns, with_spec, with_spikes

# The five units, keyed by user_id % 5 (id, type, health loss
# per day; None = a unit that recovers).
UNITS = [
    (0, "Motor_001", "Motor", None),
    (1, "Motor_002", "Motor", 1.2),
    (2, "ConveyorBelt_001", "ConveyorBelt", 2.0),
    (3, "ConveyorBelt_002", "ConveyorBelt", 2.2),
    (4, "Chiller_001", "Chiller", 3.5),
]
EPOCH = dt.date(2024, 1, 1)

RAW_COLUMNS = [
    "timestamp", "equipment_id", "equipment_type", "health_score", "temperature",
    "vibration", "power_consumption", "is_anomaly", "anomaly_reason", "load_timestamp",
]


def _by_unit(idx: int) -> str:
    return sq.case("_no", [(str(u[0]), sq.quote(u[idx]) if isinstance(u[idx], str) else sq.dbl(u[idx]))
                           for u in UNITS if u[idx] is not None])


def _sensor_value(sensor: str, z: str) -> str:
    """clamp(mean + std * z) from ``with_spec`` columns (rounded in the next step)."""
    return (f"least(greatest(_mean_{sensor} + _std_{sensor} * {z}, _min_{sensor}), _max_{sensor})")


def raw_from_events(events: DataFrame, scale_out: bool = False) -> DataFrame:
    """events -> raw readings (RAW columns + ``event_id`` as dedup tie-breaker).

    ``scale_out`` names one unit per user (``type_userid``) instead of five.
    Built in narrow steps so that every lookup is evaluated once per row;
    the expressions are SQL text, parsed once per step.
    """
    base = events.selectExpr(
        "event_id", "ts", "user_id", "value", "user_id % 5 AS _no",
        f"datediff(to_date(ts), DATE'{EPOCH.isoformat()}') AS _dn",
    )
    unit_id = ("concat(equipment_type, '_', CAST(user_id AS STRING))" if scale_out else _by_unit(1))
    typed = base.selectExpr("*", f"{_by_unit(2)} AS equipment_type", f"{_by_unit(3)} AS _loss")
    units = typed.selectExpr("*", f"{unit_id} AS equipment_id")
    specced = with_spec(units).selectExpr(
        "*",
        "(value - 50.0D) / 50.0D AS _z_t",
        "(event_id * 7919 % 1000 - 500) / 250 AS _z_v",
        "(event_id * 104729 % 1000 - 500) / 250 AS _z_p",
    )
    clamped = specced.selectExpr(
        "*",
        f"{_sensor_value('temperature', '_z_t')} AS _c_t",
        f"{_sensor_value('vibration', '_z_v')} AS _c_v",
        f"{_sensor_value('power_consumption', '_z_p')} AS _c_p",
    )
    health = ("CASE WHEN event_id % 499 = 7 THEN 101.0D "
              "WHEN _no = 0 THEN least(100.0D, 70.0D + 0.5D * _dn) "
              "ELSE greatest(0.0D, 100.0D - _loss * _dn - (event_id % 5) * 0.25D) END")
    temperature = (f"CASE WHEN event_id % 997 = 3 THEN -60.0D WHEN event_id % 101 = 5 THEN CAST(NULL AS DOUBLE) "
                   f"ELSE {sq.half_up('_c_t', 2)} END")
    df = clamped.selectExpr(
        "event_id",
        "CAST(date_trunc('minute', ts) AS TIMESTAMP_NTZ) AS timestamp",
        "equipment_id", "equipment_type",
        f"{health} AS health_score",
        f"{temperature} AS temperature",
        f"{sq.half_up('_c_v', 2)} AS vibration",
        f"{sq.half_up('_c_p', 2)} AS power_consumption",
        "ts AS load_timestamp",
    )
    spiked = with_spikes(df)
    flag, reason = anomaly_columns(spiked)
    return spiked.select(
        *RAW_COLUMNS[:7], flag.alias("is_anomaly"), reason.alias("anomaly_reason"),
        "load_timestamp", "event_id",
    )


# Rows turned bad in the "bad rows" CSV rendering.
BAD_TIMESTAMP_EVERY = (997, 11)     # event_id % 997 == 11: unparseable timestamp
LONG_ID_EVERY = (991, 13)           # event_id % 991 == 13: 51-character equipment id


def csv_text(raw: DataFrame, rotate_null_tokens: bool = False, bad_rows: bool = False,
             tokens=("", "NULL", "null", "NaN", "nan"), keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw readings rendered as the nine CSV text fields plus their batch name.

    ``rotate_null_tokens`` writes each NULL as one of the textual NULL
    tokens (chosen by event id); ``bad_rows`` corrupts a fixed subset of rows.
    ``keep`` adds columns of ``raw`` as ``_<name>``.
    """
    from .csv_ingest import CSV_FIELDS, batch_names

    eid = F.col("event_id")
    text = {f: F.col(f).cast("string") for f in CSV_FIELDS}
    text["timestamp"] = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    if bad_rows:
        m, r = BAD_TIMESTAMP_EVERY
        text["timestamp"] = F.when(eid % m == r, F.lit("not-a-time")).otherwise(text["timestamp"])
        m, r = LONG_ID_EVERY
        text["equipment_id"] = F.when(eid % m == r, F.rpad("equipment_id", 51, "X")).otherwise(
            text["equipment_id"])
    if rotate_null_tokens:
        token = F.element_at(F.array(*[F.lit(t) for t in tokens]), (F.pmod(eid, F.lit(len(tokens))) + 1).cast("int"))
        text = {f: F.coalesce(c, token) for f, c in text.items()}
    return raw.select(*[c.alias(f) for f, c in text.items()], batch_names(raw).alias("batch"),
                      *[F.col(c).alias(f"_{c}") for c in keep])


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread an input read as fewer tasks than the cluster has cores.

    A small table stored as one parquet row group is read by one task; the
    per-row mapping is the heavy part, so it is spread round-robin first. A
    table of many files is already read by many tasks and is left as is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw_readings(spark: SparkSession, sf_dir: str, scale_out: bool = False) -> DataFrame:
    return raw_from_events(spread(load_events(spark, sf_dir)), scale_out=scale_out)


__all__ = ["raw_from_events", "raw_readings", "load_events", "RAW_COLUMNS", "UNITS", "SPEC"]
