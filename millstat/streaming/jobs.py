"""Structured Streaming jobs.

* ``stream_raw`` (I4 / T1): the CSV file stream; every file is loaded once
  (the checkpoint's file log is the load ledger) and paced with
  ``maxFilesPerTrigger``. Each micro-batch is parsed with the batch parser,
  the row-error policy applied, and written idempotently: rows go to the
  ``batch_id=N`` partition with dynamic overwrite, so a replayed batch
  replaces its own output instead of adding to it.
* ``load_new`` (I6): the same log as the ledger of incremental loads.
* ``stream_latest`` (T1): the target keeps only the newest load of each
  reading, as a versioned table (``versions``): a batch writes new versions of
  the dates it touches and logs them last. Loads are in total order: load
  time, file, place in the file.
* ``stream_energy`` (T2): hourly energy as a tumbling event-time window
  with a watermark, append mode, for the hours that are closed; an overlay
  holds the hours that the watermark has not passed and those to which rows
  came late, so together they equal M1 (``energy``).
* ``stream_alerts`` (T3): the alert mart kept by increments: counts, sums and
  extremes per equipment-day, to which a batch adds its readings and from
  which it takes the readings they supersede. Late rows included.
* ``stream_row_alerts`` (T4): stateless per-reading anomaly + severity.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.keys import surrogate_key
from ..functions.numeric import half_up, scaled_long
from ..operators import marts, staging
from ..operators.anomaly import anomaly_columns, with_spikes
from ..params import DEFAULT, Params
from ..session import scratch_path
from ..sources import csv_ingest as ci
from .versions import VersionedTable, read_or_none

RAW_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("equipment_id", T.StringType()),
    T.StructField("equipment_type", T.StringType()),
    T.StructField("health_score", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
    T.StructField("power_consumption", T.DoubleType()),
    T.StructField("is_anomaly", T.IntegerType()),
    T.StructField("anomaly_reason", T.StringType()),
    T.StructField("load_timestamp", T.TimestampNTZType()),
])

ENERGY_SCHEMA = ("fact_id string, event_hour timestamp_ntz, event_date date, equipment_id string, equipment_type string, "
                 "total_power_kwh double, avg_power_kw double, peak_power_kw double, avg_temperature_c double, "
                 "max_temperature_c double, avg_vibration double, max_vibration double, avg_health_score double, "
                 "min_health_score double, anomaly_count long, reading_count long")


def _paced(reader, max_files: int | None):
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def csv_stream(spark: SparkSession, src_glob: str, max_files: int | None = None, glob: str = "*.csv") -> DataFrame:
    """The file stream of cell rows (each file exactly once; ``max_files`` paces a trigger, by default all)."""
    reader = _paced(ci.csv_reader(spark.readStream, glob, recursive=False), max_files)
    return ci.with_file_columns(reader.csv(src_glob))


def run_available(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


LEDGER = ("source_file string, rows_parsed long, rows_loaded long, errors_seen long, status string, "
          "loaded_at timestamp_ntz, load_date date, load_id long")


def load_new(spark: SparkSession, src: str, out: str, ledger: str, as_of: dt.date, glob: str = "*.csv",
             p: Params = DEFAULT, policy: str = "CONTINUE", max_files: int | None = None) -> DataFrame:
    """Load the files under ``src`` that no run has loaded; returns the ledger's rows of this run.

    The file log of the stream's checkpoint (``ledger/_files``) says which files are
    new, so no list of paths passes through the driver. A load is a micro-batch:
    its readings go to ``out/load_id=N``, then its files to ``ledger/entries/load_id=N``.
    One that dies before it is committed runs again with the same files and number
    and replaces what it wrote. Files without data rows are entered with 0
    rows; a file whose name was loaded is not loaded again.
    """
    first = [None]

    def batch(rows: DataFrame, load_id: int) -> None:
        first[0] = load_id if first[0] is None else first[0]
        cells = ci.written(ci.with_layout(rows), "csv-cells")
        parsed = ci.parse_rows(cells, p, load_ts=as_of)
        good, _ = ci.apply_load_policy(parsed, policy)
        _write_batch(ci.with_event_date(good.select(*ci.RAW_COLUMNS)), "load_id", load_id, out, "event_date")
        files = cells.select("source_file").distinct().withColumn("loaded_at", F.lit(str(as_of)).cast("timestamp_ntz"))
        report = ci.load_report(parsed, policy, files).withColumn("load_date", F.lit(as_of))
        _write_batch(report, "load_id", load_id, f"{ledger}/entries")

    reader = _paced(ci.csv_reader(spark.readStream, glob), max_files)
    run_available(ci.with_file_columns(reader.csv(src)).writeStream.foreachBatch(batch)
                  .option("checkpointLocation", f"{ledger}/_files").trigger(availableNow=True).start())
    entries = load_entries(spark, ledger)
    return entries.where(F.lit(False)) if first[0] is None else entries.where(F.col("load_id") >= first[0])


def load_entries(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger: one row per file that ``load_new`` has loaded."""
    found = read_or_none(spark, f"{ledger}/entries", LEDGER)
    return spark.createDataFrame([], LEDGER) if found is None else found


def _write_batch(rows: DataFrame, key: str, number: int, out: str, *parts: str) -> None:
    """Rows of one batch as partition ``key=number``, replacing what an earlier try left there."""
    rows = rows.withColumn(key, F.lit(number).cast("long"))
    rows = rows.hint("rebalance", *parts) if parts else rows
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key, *parts).parquet(out))


def stream_raw(spark: SparkSession, src_glob: str, out: str, checkpoint: str, report: str | None = None,
               p: Params = DEFAULT, policy: str = "CONTINUE", max_files: int | None = None,
               load_ts=None, on_batch=None, positions: bool = False):
    """I4: load every new file once into ``out`` (parquet, ``batch_id`` / ``event_date`` partitions).

    ``positions`` keeps the place of each row in its file. ``on_batch(rows, batch_id)``
    runs after the batch is written, on what was written.
    """
    def batch(rows: DataFrame, batch_id: int) -> None:
        if positions:
            rows = ci.with_positions(rows)
        rows = ci.with_layout(rows).persist()  # the policy and report passes read the micro-batch again
        try:
            parsed = ci.parse_rows(rows, p, load_ts)
            good, _ = ci.apply_load_policy(parsed, policy)
            _write_batch(ci.with_event_date(good), "batch_id", batch_id, out, "event_date")
            if report is not None:
                _write_batch(ci.load_report(parsed, policy), "batch_id", batch_id, report)
        finally:
            rows.unpersist()
        written = read_or_none(spark, f"{out}/batch_id={batch_id}", base=out)
        if on_batch is not None and written is not None:  # None: no good row in the batch
            on_batch(written, batch_id)

    q = (csv_stream(spark, src_glob, max_files).writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    run_available(q)
    return q


# ----------------------------------------------------------------- T1

def load_order() -> list:
    """Total order of loads with one load time: file, then place in the file; newest first."""
    return [F.col(c).desc() for c in ("source_file", *ci.POSITION)]


def stream_latest(spark: SparkSession, src_glob: str, out: str, checkpoint: str, p: Params = DEFAULT,
                  policy: str = "CONTINUE", max_files: int | None = None, load_ts=None):
    """Every new file once; ``out`` keeps the newest load of each reading (``latest_readings``).

    A batch that is replayed, wherever it stopped, gives the same table.
    """
    table = VersionedTable(spark, f"{out}/latest")

    def merge(new: DataFrame, batch_id: int) -> None:
        new = new.drop("batch_id")
        dates = new.select("event_date").distinct()
        current = table.current(before=batch_id)
        if current is not None:
            new = current.join(dates, "event_date", "left_semi").unionByName(new)
        table.publish(staging.dedup_latest(new, tie_breakers=load_order()), batch_id, dates)

    return stream_raw(spark, src_glob, f"{out}/loads", checkpoint, p=p, policy=policy, max_files=max_files,
                      load_ts=load_ts, on_batch=merge, positions=True)


def latest_readings(spark: SparkSession, out: str) -> DataFrame:
    """What ``stream_latest`` keeps: raw columns of the newest load of each reading."""
    found = VersionedTable(spark, f"{out}/latest").current()
    return spark.createDataFrame([], RAW_SCHEMA) if found is None else found.select(*ci.RAW_COLUMNS)


# ----------------------------------------------------------------- T3

ALERT_KEYS = ("event_date", "equipment_id", "equipment_type")
#: counts and sums of the alert state; a reading that is superseded is taken off them
ALERT_SUMS = ("total_readings", "flag_sum", "flag_n", "health_sum", "health_n")
#: extremes of the alert state and whether the greatest value counts
ALERT_EXTREMES = {"min_health_score": False, "max_temperature_c": True, "max_vibration": True, "max_power_kw": True}


def _alert_terms(readings: DataFrame, p: Params) -> DataFrame:
    """What each in-range reading adds to the state of its equipment-day."""
    flagged = staging.range_flags(readings, p).where("NOT is_out_of_range")
    own = [c for c in readings.columns if c not in ("temperature", "vibration", "power_consumption", "health_score")]
    r = flagged.select(*own, *staging.rounded(flagged))
    return r.select(
        *[c for c in own if c not in ("is_anomaly",)],
        F.lit(1).cast("long").alias("total_readings"),
        F.coalesce(F.col("is_anomaly"), F.lit(0)).cast("long").alias("flag_sum"),
        F.col("is_anomaly").isNotNull().cast("long").alias("flag_n"),
        F.coalesce(scaled_long("health_score", 2), F.lit(0)).alias("health_sum"),
        F.col("health_score").isNotNull().cast("long").alias("health_n"),
        half_up("health_score", 2).alias("min_health_score"),
        half_up("temperature_celsius", 2).alias("max_temperature_c"),
        half_up("vibration_mm_s", 4).alias("max_vibration"),
        half_up("power_kw", 2).alias("max_power_kw"),
    )


def _winners_changed(loads: DataFrame, batch_id: int) -> DataFrame:
    """Readings of the batch that win over all loads before (kind "a"), and those they supersede (kind "r").

    Of the earlier loads only those of the batch's readings are looked at.
    """
    new = loads.where(F.col("batch_id") == batch_id)
    keys = list(staging.DEDUP_KEYS)
    before = (loads.where(F.col("batch_id") < batch_id)
              .join(new.select("event_date", *keys).distinct(), ["event_date", *keys], "left_semi"))
    both = before.unionByName(new).withColumn("_new", F.col("batch_id") == batch_id)
    order = [F.col("load_timestamp").desc_nulls_first(), *load_order()]
    by_key = Window.partitionBy(*keys)
    ranked = both.select(
        "*", F.row_number().over(by_key.orderBy(*order)).alias("_rank"),
        F.first("_new").over(by_key.orderBy(*order)).alias("_new_wins"),
        F.row_number().over(by_key.orderBy("_new", *order)).alias("_rank_before"))
    added = F.col("_rank") == 1
    removed = (F.col("_rank_before") == 1) & ~F.col("_new")
    return (ranked.where(F.col("_new_wins") & (added | removed))
            .withColumn("kind", F.when(added, "a").otherwise("r"))
            .drop("_new", "_rank", "_new_wins", "_rank_before", "batch_id"))


def _merged_state(state: DataFrame | None, terms: DataFrame) -> DataFrame:
    """State with the terms added and taken off; ``dirty`` where an extreme may have gone with a superseded reading."""
    cols = [*ALERT_KEYS, *ALERT_SUMS, *ALERT_EXTREMES, "kind"]
    rows = terms.select(*cols)
    if state is not None:
        rows = state.withColumn("kind", F.lit("s")).select(*cols).unionByName(rows)
    sign = F.when(F.col("kind") == "r", -1).otherwise(1)
    aggs = [F.sum(F.col(c) * sign).alias(c) for c in ALERT_SUMS]
    dirty = F.lit(False)
    for c, greatest in ALERT_EXTREMES.items():
        pick = F.max if greatest else F.min
        for kind in "sar":
            aggs.append(pick(F.when(F.col("kind") == kind, F.col(c))).alias(f"_{kind}_{c}"))
        s, a, r = (F.col(f"_{kind}_{c}") for kind in "sar")
        lost = (r >= s) if greatest else (r <= s)
        made_good = (a >= s) if greatest else (a <= s)
        dirty = dirty | (F.coalesce(lost, F.lit(False)) & ~F.coalesce(made_good, F.lit(False)))
    merged = rows.groupBy(*ALERT_KEYS).agg(*aggs)
    return merged.select(
        *ALERT_KEYS, *ALERT_SUMS,
        *[(F.greatest if g else F.least)(f"_s_{c}", f"_a_{c}").alias(c) for c, g in ALERT_EXTREMES.items()],
        dirty.alias("dirty")).where("total_readings > 0")


def _alerts_of(state: DataFrame, p: Params) -> DataFrame:
    """M2 rows of the state, with the state's own columns beside them."""
    health = F.col("health_sum").cast("double") / F.lit(100.0) / F.col("health_n")
    daily = state.select(
        *ALERT_KEYS, F.col("total_readings").alias("reading_count"),
        F.when(F.col("flag_n") > 0, F.col("flag_sum")).alias("anomaly_count"),
        half_up(F.when(F.col("health_n") > 0, health), 2).alias("avg_health_score"),
        *ALERT_EXTREMES, *ALERT_SUMS[1:])
    return marts.alert_maintenance(daily, p, daily, keep=ALERT_SUMS[1:])


def stream_alerts(spark: SparkSession, src_glob: str, raw_out: str, alerts_out: str, checkpoint: str,
                  p: Params = DEFAULT, policy: str = "CONTINUE", max_files: int | None = None, load_ts=None):
    """Raw load plus an incremental, exact alert mart (``current_alerts``).

    Per batch: the readings that win over earlier loads and those they
    supersede change counts and sums of their equipment-days. Only where a
    superseded reading held an extreme are the readings of that equipment-day
    read again. The state is the mart itself, versioned by batch.
    """
    table = VersionedTable(spark, alerts_out)

    def refresh(new: DataFrame, batch_id: int) -> None:
        dates = new.select("event_date").distinct()
        loads = spark.read.parquet(raw_out).where(F.col("batch_id") <= batch_id).join(dates, "event_date", "left_semi")
        state = table.current(before=batch_id)
        if state is not None:
            state = state.join(dates, "event_date", "left_semi")
        terms = _alert_terms(_winners_changed(loads, batch_id), p)
        path = scratch_path(spark, "alert-state")  # both branches below read it
        _merged_state(state, terms).write.parquet(path)
        merged = spark.read.parquet(path)
        days = merged.where("dirty").select("event_date", "equipment_id").distinct()
        again = staging.dedup_latest(loads.drop("batch_id").join(days, ["event_date", "equipment_id"], "left_semi"),
                                     tie_breakers=load_order())
        anew = _merged_state(None, _alert_terms(again, p).withColumn("kind", F.lit("a")))
        kept = merged.join(days, ["event_date", "equipment_id"], "left_anti").unionByName(anew)
        table.publish(_alerts_of(kept.drop("dirty"), p), batch_id, dates)

    return stream_raw(spark, src_glob, raw_out, checkpoint, p=p, policy=policy, max_files=max_files,
                      load_ts=load_ts, on_batch=refresh, positions=True)


def current_alerts(spark: SparkSession, alerts_out: str) -> DataFrame | None:
    """The alert mart that ``stream_alerts`` keeps; None before the first batch."""
    found = VersionedTable(spark, alerts_out).current()
    return None if found is None else found.drop(*ALERT_SUMS[1:])


_US_PER_DAY = 86_400_000_000


def naive_as_utc_instant(ts):
    """timestamp_ntz -> timestamp with the same wall clock in UTC, zone-free arithmetic."""
    micros = (F.unix_date(F.to_date(ts)).cast("long") * _US_PER_DAY
              + (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * 1_000_000
              + (F.second(ts).cast("long") * 1_000_000))
    return F.timestamp_micros(micros)


def utc_instant_as_naive(ts):
    """Inverse of ``naive_as_utc_instant`` for whole-second instants."""
    micros = F.unix_micros(ts)
    days = F.floor(micros / _US_PER_DAY).cast("int")
    rest = micros - days.cast("long") * _US_PER_DAY
    day = F.date_from_unix_date(days)
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                (rest / 3_600_000_000).cast("int"),
                                ((rest % 3_600_000_000) / 60_000_000).cast("int"),
                                ((rest % 60_000_000) / 1_000_000).cast("decimal(8,6)"))


# ----------------------------------------------------------------- T2

LATE_POLICIES = ("repair", "fail", "allow")


class LateReadings(RuntimeError):
    """Readings came after their hour was closed."""


@dataclass(frozen=True)
class EnergyRun:
    """What a run of ``stream_energy`` did: readings in closed hours, in open ones, and come too late; hours computed again."""

    closed_readings: int
    open_readings: int
    late_readings: int
    hours_recomputed: int
    dropped_by_watermark: int


def _key_join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the keys of M1; a NULL type equals a NULL type. Columns of both sides, the keys from the left."""
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in marts.ENERGY_KEYS else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in marts.ENERGY_KEYS:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    out = left.join(right, same, how)
    return out.drop(*[c for c in out.columns if c.startswith("_r_")])


def _count_arrivals(spark: SparkSession, staged: DataFrame, out: str, checkpoint: str, max_files: int | None,
                    staged_dir: str) -> None:
    """Readings that have arrived, by equipment-hour and batch: a stream of its own, nothing is ever late for it."""
    def batch(rows: DataFrame, batch_id: int) -> None:
        _write_batch(rows.groupBy(*marts.ENERGY_KEYS).agg(F.count(F.lit(1)).alias("arrived")), "batch_id", batch_id, out)

    src = _paced(spark.readStream.schema(staged.schema), max_files).parquet(staged_dir).select(*marts.ENERGY_KEYS)
    run_available(src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())


def stream_energy(spark: SparkSession, staged_dir: str, out: str, checkpoint: str,
                  watermark: str = "1 hour", max_files: int | None = None, late: str = "repair") -> EnergyRun:
    """M1 as a tumbling one-hour event-time window with a watermark (append), made whole.

    Input: staged, in-range readings (parquet files, which are only added to). Closed hours are
    appended to ``out/closed``. A second stream counts what has arrived per
    equipment-hour; where more has arrived than an hour was closed with (hours that
    the watermark has not passed, and hours that rows came late to) that hour is
    computed from the readings and kept in the versioned ``out/overlay``, which
    goes before ``closed``. ``energy`` reads both.

    ``late``: "repair" computes closed hours again; "fail" raises
    ``LateReadings`` before anything of the overlay changes; "allow" leaves late readings out.
    """
    if late not in LATE_POLICIES:
        raise ValueError(f"late must be one of {LATE_POLICIES}")
    staged = spark.read.parquet(staged_dir)
    src = (_paced(spark.readStream.schema(staged.schema), max_files).parquet(staged_dir)
           # watermarks need a zone-aware timestamp: take the instant whose UTC
           # wall clock is the naive event time (no session-zone conversion)
           .withColumn("_event_ts", naive_as_utc_instant(F.col("event_timestamp")))
           .withWatermark("_event_ts", watermark))
    agg = src.groupBy(F.window("_event_ts", "1 hour").alias("w"), "equipment_id", "equipment_type").agg(*marts.energy_aggs())
    hour = utc_instant_as_naive(F.col("w.start"))
    shaped = agg.select(hour.alias("event_hour"), F.to_date(hour).alias("event_date"), "equipment_id", "equipment_type",
                        *[name for _, name in marts.ENERGY_AGGS])
    keyed = shaped.select(surrogate_key(shaped, "event_hour", "equipment_id").alias("fact_id"), "*")
    q = (keyed.writeStream.outputMode("append").format("parquet").option("path", f"{out}/closed")
         .option("checkpointLocation", f"{checkpoint}/closed").trigger(availableNow=True).start())
    run_available(q)
    dropped = sum(o["numRowsDroppedByWatermark"] for x in q.recentProgress for o in x["stateOperators"])
    _count_arrivals(spark, staged, f"{out}/arrivals", f"{checkpoint}/arrivals", max_files, staged_dir)
    return _overlay_energy(spark, staged_dir, out, late, dropped)


def _overlay_energy(spark: SparkSession, staged_dir: str, out: str, late: str, dropped: int) -> EnergyRun:
    arrivals = read_or_none(spark, f"{out}/arrivals")
    if arrivals is None:  # no input yet
        return EnergyRun(0, 0, 0, 0, dropped)
    arrived = arrivals.groupBy(*marts.ENERGY_KEYS).agg(F.sum("arrived").alias("arrived"))
    closed = _closed(spark, out)
    last = closed.agg(F.max("event_hour")).scalar()  # every hour up to it is closed
    counts = _key_join(arrived, closed.select(*marts.ENERGY_KEYS, F.col("reading_count").alias("in_closed")), "left")
    path = scratch_path(spark, "energy-counts")
    (counts.select(*marts.ENERGY_KEYS, "arrived", F.coalesce("in_closed", F.lit(0)).cast("long").alias("in_closed"),
                   F.coalesce(F.col("event_hour") <= last, F.lit(False)).alias("is_closed")).write.parquet(path))
    counts = spark.read.parquet(path)
    more = F.col("arrived") - F.col("in_closed")
    seen = counts.agg(F.sum(F.when(F.col("is_closed"), F.col("in_closed"))), F.sum(F.when(~F.col("is_closed"), more)),
                      F.sum(F.when(F.col("is_closed"), more))).first()
    n_closed, n_open, n_late = (v or 0 for v in seen)
    if n_late and late == "fail":
        raise LateReadings(f"{n_late} readings came after their hour was closed")
    wanted = counts.where(more > 0)
    if late == "allow":
        wanted = wanted.where("NOT is_closed")
    table = VersionedTable(spark, f"{out}/overlay")
    version = table.last_version() + 1
    held = table.current(before=version)
    if held is None:
        stale, dates = wanted, wanted.select("event_date")
    else:
        stale = _key_join(wanted, held.select(*marts.ENERGY_KEYS, F.col("reading_count").alias("_held")), "left").where(
            "_held IS NULL OR _held < arrived").drop("_held")
        done = _key_join(held.select(*marts.ENERGY_KEYS), wanted.select(*marts.ENERGY_KEYS), "left_anti")
        dates = stale.select("event_date").unionByName(done.select("event_date"))
    # written: their sizes decide the joins with the readings, and the dates do not depend on this version
    stale_path, dates_path = scratch_path(spark, "energy-stale"), scratch_path(spark, "energy-dates")
    stale.select(*marts.ENERGY_KEYS).write.parquet(stale_path)
    dates.distinct().write.parquet(dates_path)
    stale, dates = spark.read.parquet(stale_path), spark.read.parquet(dates_path)
    n_stale = stale.count()
    if dates.isEmpty():
        return EnergyRun(n_closed, n_open, n_late, 0, dropped)
    readings = spark.read.parquet(staged_dir)
    fresh = marts.fact_energy(_key_join(readings, stale, "left_semi"))
    if held is not None:
        keep = _key_join(held.join(dates, "event_date", "left_semi"), wanted.select(*marts.ENERGY_KEYS), "left_semi")
        fresh = fresh.unionByName(_key_join(keep, stale, "left_anti").select(*fresh.columns))
    table.publish(fresh, version, dates)
    return EnergyRun(n_closed, n_open, n_late, n_stale, dropped)


def _closed(spark: SparkSession, out: str) -> DataFrame:
    found = read_or_none(spark, f"{out}/closed")
    return found if found is not None else spark.createDataFrame([], ENERGY_SCHEMA)


def energy(spark: SparkSession, out: str) -> DataFrame:
    """What ``stream_energy`` has: closed hours, those of the overlay in its place."""
    closed = _closed(spark, out)
    overlay = VersionedTable(spark, f"{out}/overlay").current()
    if overlay is None:
        return closed
    return _key_join(closed, overlay.select(*marts.ENERGY_KEYS), "left_anti").unionByName(overlay.select(*closed.columns))


# ----------------------------------------------------------------- T4

def row_alerts(raw: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """T4 body: recomputed spike rule and row severity on raw readings."""
    spiked = with_spikes(raw, p=p)
    flag, reason = anomaly_columns(spiked)
    h = F.col("health_score")
    return (spiked.select("*", flag.alias("_flag"), reason.alias("_reason"))
            .filter((F.col("_flag") == 1) & (h < 50))
            .select("timestamp", "equipment_id", "equipment_type", "health_score",
                    F.col("_reason").alias("anomaly_reason"), rules.severity(h).alias("alert_severity")))


def stream_row_alerts(spark: SparkSession, raw_dir: str, out: str, checkpoint: str, p: Params = DEFAULT,
                      max_files: int | None = None):
    """T4: stateless row alerts over a stream of raw readings (append)."""
    src = _paced(spark.readStream.schema(RAW_SCHEMA), max_files).parquet(raw_dir)
    q = (row_alerts(src, p).writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    run_available(q)
    return q
