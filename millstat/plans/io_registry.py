"""Registered ingestion, build and streaming keys.

Each entry renders the ``events``-derived raw readings as daily CSV batch
files (or parquet files) in a fresh folder under the session's shared
checkpoint folder, runs the load/stream job on them, and returns what the
job wrote, read back. The oracle SQL is the batch twin on the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import staging
from ..session import scratch_path
from ..sources import csv_ingest as ci
from ..sources import fixture
from ..streaming import jobs as sp
from . import build
from .oracle import date_lit, dbl, eavg, hu
from .registry import Frames, reg

LOAD_TS = "2024-02-01 00:00:00"
FIELDS = ", ".join(f'"{f}"' if f == "timestamp" else f for f in ci.CSV_FIELDS)
RAW9 = f"SELECT {FIELDS} FROM raw"
RAW9_STAMPED = f"SELECT {FIELDS}, TIMESTAMP '{LOAD_TS}' AS load_timestamp FROM raw"
# The rows the "bad" CSV rendering corrupts (unparseable timestamp, over-long
# id). Every row is still written and read; the oracles use this to state the
# expected outcome: CONTINUE drops exactly these rows, SKIP_FILE their days.
BAD_ROW = (f"(event_id % {fixture.BAD_TIMESTAMP_EVERY[0]} = {fixture.BAD_TIMESTAMP_EVERY[1]} "
           f"OR event_id % {fixture.LONG_ID_EVERY[0]} = {fixture.LONG_ID_EVERY[1]})")
BATCH_SQL = ("printf('batch_%03d_%s_%s', date_diff('day', (SELECT min(CAST(\"timestamp\" AS DATE)) FROM raw), "
             "CAST(\"timestamp\" AS DATE)) + 1, strftime(CAST(\"timestamp\" AS DATE), '%Y%m%d'), "
             "strftime(CAST(\"timestamp\" AS DATE) + 1, '%Y%m%d'))")


def _batches(f: Frames, kind: str = "plain", rows: DataFrame | None = None) -> str:
    """Write the fixture readings as daily CSV batches; returns the folder."""
    out = scratch_path(f.spark, f"batches-{kind}")
    src = f.raw if rows is None else rows
    txt = fixture.csv_text(src, rotate_null_tokens=(kind == "tokens"), bad_rows=(kind == "bad"))
    ci.write_daily_batches(txt, out)
    return out


def _batch_of(col: str = "source_file"):
    return F.regexp_extract(F.col(col), r"batch=([^/]+)/", 1)


# ----------------------------------------------------------------- I1-I3

@reg("ingest_csv", lambda o: o.sql(RAW9_STAMPED, "raw"))
def _i1(f: Frames):
    good, _ = ci.apply_load_policy(ci.read_sensor_csv(f.spark, _batches(f), p=f.p, load_ts=LOAD_TS))
    return good.select(*ci.RAW_COLUMNS)


@reg("null_tokens", lambda o: o.sql(RAW9_STAMPED, "raw"))
def _i2(f: Frames):
    src = _batches(f, "tokens")
    good, _ = ci.apply_load_policy(ci.read_sensor_csv(f.spark, src, p=f.p, load_ts=LOAD_TS))
    return good.select(*ci.RAW_COLUMNS)


@reg("load_continue", lambda o: o.sql(f"{RAW9_STAMPED} WHERE NOT {BAD_ROW}", "raw"))
def _i3a(f: Frames):
    parsed = ci.read_sensor_csv(f.spark, _batches(f, "bad"), p=f.p, load_ts=LOAD_TS)
    return ci.apply_load_policy(parsed, "CONTINUE")[0].select(*ci.RAW_COLUMNS)


@reg("load_skip_file", lambda o: o.sql(
    f"{RAW9_STAMPED} WHERE CAST(\"timestamp\" AS DATE) NOT IN "
    f"(SELECT CAST(\"timestamp\" AS DATE) FROM raw WHERE {BAD_ROW})", "raw"))
def _i3b(f: Frames):
    parsed = ci.read_sensor_csv(f.spark, _batches(f, "bad"), p=f.p, load_ts=LOAD_TS)
    return ci.apply_load_policy(parsed, "SKIP_FILE")[0].select(*ci.RAW_COLUMNS)


# ----------------------------------------------------------------- I4 stream ingest

@reg("stream_ingest", lambda o: o.sql(RAW9, "raw"))
def _i4(f: Frames):
    src = _batches(f)
    out, ckpt = scratch_path(f.spark, "stream-raw"), scratch_path(f.spark, "stream-ckpt")
    sp.stream_raw(f.spark, f"{src}/*/*.csv", out, ckpt, p=f.p, max_files=1)
    # a rerun finds no new files and adds nothing
    sp.stream_raw(f.spark, f"{src}/*/*.csv", out, ckpt, p=f.p, max_files=1)
    return f.spark.read.parquet(out).select(*ci.CSV_FIELDS)


# ----------------------------------------------------------------- I5-I12

@reg("reload_raw", lambda o: o.sql(RAW9_STAMPED, "raw"))
def _i5(f: Frames):
    src = _batches(f)
    out = scratch_path(f.spark, "raw")
    ci.reload_raw(f.spark, src, out, p=f.p, load_ts=LOAD_TS)
    # FORCE semantics: a second reload replaces, never appends
    return ci.reload_raw(f.spark, src, out, p=f.p, load_ts=LOAD_TS).select(*ci.RAW_COLUMNS)


@reg("incremental_load", lambda o: o.sql(RAW9, "raw"))
def _i6(f: Frames):
    src = _batches(f)
    out, ledger = scratch_path(f.spark, "raw"), scratch_path(f.spark, "ledger")
    day = dt.date(2024, 2, 1)
    sp.load_new(f.spark, src, out, ledger, day, p=f.p)
    sp.load_new(f.spark, src, out, ledger, day + dt.timedelta(days=1), p=f.p)  # nothing new
    return f.spark.read.parquet(out).select(*ci.CSV_FIELDS)


@reg("load_report", lambda o: o.sql(f"""
SELECT batch, count(*) AS rows_parsed, count(*) - count(*) FILTER (WHERE {BAD_ROW}) AS rows_loaded,
  count(*) FILTER (WHERE {BAD_ROW}) AS errors_seen,
  CASE WHEN count(*) FILTER (WHERE {BAD_ROW}) = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status
FROM (SELECT *, {BATCH_SQL} AS batch FROM raw) t GROUP BY batch""", "raw"))
def _i7(f: Frames):
    parsed = ci.read_sensor_csv(f.spark, _batches(f, "bad"), p=f.p, load_ts=LOAD_TS)
    rep = ci.load_report(parsed, "CONTINUE")
    return rep.select(_batch_of().alias("batch"), "rows_parsed", "rows_loaded", "errors_seen", "status")


_REPORT = f"""(SELECT batch, count(*) AS n, count(*) FILTER (WHERE {BAD_ROW}) AS bad
  FROM (SELECT *, {BATCH_SQL} AS batch FROM raw) t GROUP BY batch) r"""


@reg("load_totals", lambda o: o.sql(f"""
SELECT count(*) AS files_processed, CAST(coalesce(sum(CASE WHEN bad = 0 THEN n ELSE 0 END), 0) AS BIGINT) AS rows_loaded,
  CAST(sum(bad) AS BIGINT) AS errors_seen FROM {_REPORT}""", "raw"))
def _i7b(f: Frames):
    # one row per batch: files of a batch that was cut are taken together
    parsed = ci.read_sensor_csv(f.spark, _batches(f, "bad"), p=f.p, load_ts=LOAD_TS)
    return ci.load_totals(ci.load_report(parsed.withColumn("source_file", _batch_of()), "SKIP_FILE"))


# a day's batch is loaded at noon of the next day; the history covers the 72 hours before an instant
@reg("load_history", lambda o: o.sql(f"""
SELECT batch, n AS rows_parsed, n - bad AS rows_loaded, bad AS errors_seen FROM (
  SELECT *, CAST(strptime(split_part(batch, '_', 4), '%Y%m%d') AS TIMESTAMP) + INTERVAL 12 HOUR AS loaded_at FROM {_REPORT}) h
WHERE loaded_at > TIMESTAMP '2024-01-20 12:00:00' AND loaded_at <= TIMESTAMP '2024-01-23 12:00:00'""", "raw"))
def _i7c(f: Frames):
    parsed = ci.read_sensor_csv(f.spark, _batches(f, "bad"), p=f.p, load_ts=LOAD_TS)
    batch = parsed.withColumn("source_file", _batch_of())
    stamp = F.to_timestamp_ntz(F.element_at(F.split("source_file", "_"), 4), F.lit("yyyyMMdd")) + F.expr("INTERVAL 12 HOURS")
    report = ci.load_report(batch.withColumn("load_timestamp", stamp), "CONTINUE")
    return ci.load_history(report, "2024-01-23 12:00:00", hours=72).select(
        F.col("source_file").alias("batch"), "rows_parsed", "rows_loaded", "errors_seen")


@reg("load_health_check", lambda o: o.sql(f"""
SELECT equipment_id, {hu(eavg('h', 2), 2)} AS avg_health, min(h) AS min_health, count(*) AS readings,
  coalesce({hu(eavg('h', 2), 2)} > 30e0, false) AS health_ok
FROM (SELECT equipment_id, {hu('health_score', 2)} AS h FROM raw) t GROUP BY equipment_id""", "raw"))
def _i8(f: Frames):
    return ci.load_health_check(f.raw)


@reg("row_counts", lambda o: o.sql(
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}"
                       for n, t in [("raw", "raw"), ("stg", "stg"), ("energy", "energy"), ("alert", "alert"),
                                    ("oee", "oee"), ("forecast", "forecast")]),
    "raw", "stg", "energy", "alert", "oee", "forecast"), shared=("stg", "daily"))
def _i9(f: Frames):
    return build.row_counts({"raw": f.raw, "stg": f.stg, "energy": f.energy, "alert": f.alerts,
                             "oee": f.oee, "forecast": f.forecast})


@reg("merge_batches", lambda o: o.sql(RAW9, "raw"))
def _i10(f: Frames):
    return ci.merge_batches(f.spark, _batches(f), scratch_path(f.spark, "merged"), p=f.p)


@reg("write_daily_batches", lambda o: o.sql(f"SELECT {BATCH_SQL} AS batch, {FIELDS} FROM raw", "raw"))
def _i11(f: Frames):
    cells = ci.stage_cells(f.spark, _batches(f), glob="*batch*.csv")  # by the files' own names
    parsed = ci.parse_rows(cells, p=f.p)
    return parsed.select(F.regexp_extract("source_file", r"(batch_\d+_\d+_\d+)_\d+\.csv$", 1).alias("batch"), *ci.CSV_FIELDS)


@reg("load_stamp", lambda o: o.sql(f"SELECT \"timestamp\", equipment_id, TIMESTAMP '{LOAD_TS}' AS load_timestamp "
                                   "FROM raw", "raw"))
def _i12(f: Frames):
    good, _ = ci.apply_load_policy(ci.read_sensor_csv(f.spark, _batches(f), p=f.p, load_ts=LOAD_TS))
    return good.select("timestamp", "equipment_id", "load_timestamp")


# per table a count and exact sums of its measures, in hundredths; staged readings also by their newest load
BUILD_SUMS = {
    "stg": ("temperature_celsius", "power_kw", "health_score"),
    "energy": ("total_power_kwh", "max_temperature_c", "reading_count"),
    "alert": ("avg_health_score", "anomaly_rate_pct", "total_readings"),
    "oee": ("availability_pct", "performance_pct", "oee_score"),
    "forecast": ("current_health_score", "current_min_health", "reading_count"),
}


@reg("build_marts", lambda o: o.sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT {key}) AS distinct_keys, "
    + ", ".join(f"CAST(sum(CAST(round({c} * 100e0) AS BIGINT)) AS BIGINT) AS sum_{n}" for n, c in enumerate(cols, 1)) + f" FROM {t}"
    for (t, cols), key in zip(BUILD_SUMS.items(), ("sensor_id", "fact_id", "alert_id", "oee_id", "forecast_id"))),
    *BUILD_SUMS))
def _i13(f: Frames):
    paths = build.build_marts(f.spark, f.raw, scratch_path(f.spark, "warehouse"), f.p)
    parts = []
    for (t, cols), key in zip(BUILD_SUMS.items(), ("sensor_id", "fact_id", "alert_id", "oee_id", "forecast_id")):
        parts.append(f.spark.read.parquet(paths[t]).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_keys"),
            *[F.sum(F.round(F.col(c) * 100.0).cast("long")).alias(f"sum_{n}") for n, c in enumerate(cols, 1)])
            .select(F.lit(t).alias("table_name"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ----------------------------------------------------------------- T1-T4

def _deliver(rows: DataFrame, out: str) -> None:
    """Adds readings to ``out`` as CSV files in which the loads of a reading stand in the order of their load times.

    All loads of a reading that are delivered together share a file: the range is cut by reading.
    """
    reading = ["batch", "timestamp", "equipment_id"]
    txt = fixture.csv_text(rows, keep=("load_timestamp", "event_id"))
    (txt.repartitionByRange(*reading).sortWithinPartitions(*reading, "_load_timestamp", "_event_id")
     .select(*ci.CSV_FIELDS, "batch").write.mode("append").option("header", True).partitionBy("batch").csv(out))


# the second delivery holds every other event: repeats meet within files and across deliveries, and an
# older load that is delivered later wins
@reg("stream_dedup", lambda o: o.sql(f"""
SELECT {FIELDS} FROM (SELECT *, row_number() OVER (PARTITION BY "timestamp", equipment_id
  ORDER BY event_id % 2 DESC, load_timestamp DESC, event_id DESC) AS rn FROM raw) t WHERE rn = 1""", "raw"))
def _t1(f: Frames):
    src = scratch_path(f.spark, "deliveries")
    out, ckpt = scratch_path(f.spark, "stream-latest"), scratch_path(f.spark, "stream-ckpt")
    for half in (0, 1):
        _deliver(f.raw.where(F.col("event_id") % 2 == half), src)
        sp.stream_latest(f.spark, f"{src}/*/*.csv", out, ckpt, p=f.p)
    return sp.latest_readings(f.spark, out).select(*ci.CSV_FIELDS)


# every other day is delivered in a second run, when its hours have been closed
@reg("stream_energy", lambda o: o.sql("SELECT * FROM energy", "energy"), shared=("stg",))
def _t2(f: Frames):
    staged = scratch_path(f.spark, "staged")
    out, ckpt = scratch_path(f.spark, "stream-energy"), scratch_path(f.spark, "stream-ckpt")
    for half in (0, 1):
        (staging.valid_only(f.stg).where(F.dayofyear("event_date") % 2 == half).hint("rebalance", "event_date")
         .write.mode("append").partitionBy("event_date").parquet(staged))
        sp.stream_energy(f.spark, staged, out, ckpt, watermark="1 hour")
    return sp.energy(f.spark, out)


# the newest load of every third reading comes in a second delivery and supersedes what was counted
@reg("stream_alerts", lambda o: o.sql("SELECT * FROM alert", "alert"))
def _t3(f: Frames):
    newest = F.max(F.struct("load_timestamp", "event_id")).over(Window.partitionBy("timestamp", "equipment_id"))
    late = (F.col("event_id") % 3 == 0) & (F.col("_newest.event_id") == F.col("event_id"))
    rows = f.raw.withColumn("_newest", newest)
    src = scratch_path(f.spark, "deliveries")
    raw_out, alerts_out = scratch_path(f.spark, "stream-raw"), scratch_path(f.spark, "stream-alerts")
    ckpt = scratch_path(f.spark, "stream-ckpt")
    for part in (~late, late):
        _deliver(rows.where(part), src)
        sp.stream_alerts(f.spark, f"{src}/*/*.csv", raw_out, alerts_out, ckpt, p=f.p)
    return sp.current_alerts(f.spark, alerts_out)


@reg("stream_row_alerts", lambda o: o.sql(f"""
SELECT "timestamp", equipment_id, equipment_type, health_score, anomaly_reason,
  CASE WHEN health_score < 30e0 THEN 'CRITICAL' WHEN health_score < 50e0 THEN 'HIGH'
       WHEN health_score < 70e0 THEN 'MEDIUM' ELSE 'LOW' END AS alert_severity
FROM raw WHERE is_anomaly = 1 AND health_score < 50e0""", "raw"))
def _t4(f: Frames):
    raw_dir = scratch_path(f.spark, "raw-parquet")
    ci.write_raw(f.raw.select(*ci.RAW_COLUMNS), raw_dir, "overwrite")
    out, ckpt = scratch_path(f.spark, "stream-rows"), scratch_path(f.spark, "stream-ckpt")
    sp.stream_row_alerts(f.spark, raw_dir, out, ckpt, p=f.p)
    return f.spark.read.parquet(out)


__all__ = ["dbl", "date_lit"]
