"""Sensor CSV ingestion.

Spark's CSV reader maps columns by position. The reference loads by
column name, and a file whose header lists the fields in another order
must still load correctly. A load therefore parses the CSV once: every line
is read as nine text cells (quotes handled by Spark) with its file and its
place in it, and written as Parquet (``stage_cells``). There ``layout`` is NULL
but for header rows, so one narrow aggregate of two columns finds the files
whose header is missing or in another order: the odd files. Rows of all other files
take their fields by position; only the odd files' layouts, a small
written table, are joined, so no row moves by its file.

Row error policy:
* CONTINUE  - drop only the bad rows;
* SKIP_FILE - drop every row of a file that has a bad row (the bad files are
  a small written table as well).
A row is bad when its file has no header, it is malformed (field count,
quoting), a
non-NULL field does not parse as its type, the timestamp or equipment id
is NULL, or a text field is longer than the raw table allows.

Incremental loads (I6) are ``streaming.jobs.load_new``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from ..session import scratch_path

# CSV fields in the order the generator writes them, and their types.
CSV_FIELDS = [
    "timestamp", "equipment_id", "equipment_type", "health_score", "temperature",
    "vibration", "power_consumption", "is_anomaly", "anomaly_reason",
]
FIELD_TYPES = {
    "timestamp": "timestamp_ntz", "equipment_id": "string", "equipment_type": "string",
    "health_score": "double", "temperature": "double", "vibration": "double",
    "power_consumption": "double", "is_anomaly": "int", "anomaly_reason": "string",
}
RAW_COLUMNS = CSV_FIELDS + ["load_timestamp"]
POLICIES = ("CONTINUE", "SKIP_FILE")


CELLS = [f"c{i}" for i in range(len(CSV_FIELDS))]
CELL_SCHEMA = ", ".join(f"{c} STRING" for c in CELLS) + ", _corrupt_record STRING"


def csv_reader(reader, glob: str = "*.csv", recursive: bool = True):
    """Options shared by the batch and the stream reader: every line is a row
    of nine text cells (headers included, found later by content); a line
    with a wrong field count or broken quoting keeps its text in
    ``_corrupt_record``."""
    r = (reader.schema(CELL_SCHEMA).option("header", False).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", glob))
    return r.option("recursiveFileLookup", "true") if recursive else r


def with_file_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        *CELLS, "_corrupt_record",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


#: place of a row inside its file, where rows carry it (``with_positions``)
POSITION = ["block_start", "line"]


def with_positions(rows: DataFrame) -> DataFrame:
    """Adds ``line``: ascending within each block of a file, so (block_start, line) is the order of a file's rows.

    For cell rows as read, before any shuffle.
    """
    return rows.withColumn("line", F.monotonically_increasing_id())


def read_rows(spark: SparkSession, path, glob: str = "*.csv") -> DataFrame:
    """Cell rows of every matching file (recursively) with file path and time."""
    return with_file_columns(csv_reader(spark.read, glob).csv(path))


STANDARD = ",".join(CSV_FIELDS)


def with_layout(rows: DataFrame) -> DataFrame:
    """Adds ``layout``: of a header row the field names in their order, else NULL."""
    if "layout" in rows.columns:
        return rows
    names = F.array(*[F.lower(F.trim(F.col(c))) for c in CELLS])
    fields = F.array(*[F.lit(f) for f in CSV_FIELDS])
    is_header = (F.array_sort(names) == F.array_sort(fields)) & F.col("_corrupt_record").isNull()
    return rows.withColumn("layout", F.when(is_header, F.array_join(names, ",")))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own in the shared folder: computed once, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_cells(spark: SparkSession, path, glob: str = "*.csv") -> DataFrame:
    """The one CSV parse of a load: cell rows as Parquet."""
    return written(with_layout(read_rows(spark, path, glob)), "csv-cells")


def file_layouts(cells: DataFrame) -> DataFrame:
    """Per file its header's layout (NULL: no header); reads two columns."""
    return with_layout(cells).groupBy("source_file").agg(F.min("layout").alias("file_layout"))


def normalise_nulls(c: Column, tokens=DEFAULT.null_tokens) -> Column:
    """The textual NULL tokens become NULL (before any cast)."""
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def _load_ts(load_ts) -> Column | None:
    if load_ts is None:
        return None
    if isinstance(load_ts, (dt.datetime, dt.date)):
        load_ts = load_ts.isoformat(sep=" ") if isinstance(load_ts, dt.datetime) else load_ts.isoformat()
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def parse_rows(rows: DataFrame, p: Params = DEFAULT, load_ts=None) -> DataFrame:
    """Cell rows -> typed readings by header name, with a bad-row verdict.

    ``load_ts`` stamps every row (I12, batch loads); when None the file's
    modification time is used (stream loads).
    """
    cells = with_layout(rows)
    odd = written(file_layouts(cells).where(F.col("file_layout").isNull() | (F.col("file_layout") != STANDARD))
                  .withColumn("is_odd", F.lit(True)), "csv-odd-files")
    data = cells.where(F.col("layout").isNull()).join(odd, "source_file", "left")

    listed = F.array(*[F.col(c) for c in CELLS])
    order = F.split("file_layout", ",")
    by_name = {f: F.try_element_at(listed, F.array_position(order, f).cast("int")) for f in CSV_FIELDS}
    text = {f: normalise_nulls(F.when(F.col("is_odd"), by_name[f]).otherwise(F.col(c)), p.null_tokens)
            for f, c in zip(CSV_FIELDS, CELLS)}
    typed = {f: (text[f] if FIELD_TYPES[f] == "string" else text[f].try_cast(FIELD_TYPES[f]))
             for f in CSV_FIELDS}
    limits = {"equipment_id": p.max_id_len, "equipment_type": p.max_type_len,
              "anomaly_reason": p.max_reason_len}
    checks = [(F.col("is_odd") & F.col("file_layout").isNull(), "no_header"),
              (F.col("_corrupt_record").isNotNull(), "malformed")]
    checks += [(text[f].isNotNull() & typed[f].isNull(), f"unparseable:{f}")
               for f in CSV_FIELDS if FIELD_TYPES[f] != "string"]
    checks += [(typed["timestamp"].isNull(), "null:timestamp"),
               (typed["equipment_id"].isNull(), "null:equipment_id")]
    checks += [(F.length(typed[f]) > lim, f"too_long:{f}") for f, lim in limits.items()]
    reason = F.concat_ws(";", *[F.when(c, F.lit(r)) for c, r in checks])

    stamp = _load_ts(load_ts)
    if stamp is None:
        stamp = F.col("file_mtime").cast("timestamp_ntz")
    place = POSITION if "line" in rows.columns else []
    verdict = data.select(*[typed[f].alias(f) for f in CSV_FIELDS], stamp.alias("load_timestamp"),
                          "source_file", *place, reason.alias("_reason"))
    return verdict.select(*CSV_FIELDS, "load_timestamp", "source_file", *place,
                          (F.col("_reason") != "").alias("is_bad"),
                          F.when(F.col("_reason") != "", F.col("_reason")).alias("bad_reason"))


def read_sensor_csv(spark: SparkSession, path, glob: str = "*.csv", p: Params = DEFAULT,
                    load_ts=None) -> DataFrame:
    """Parsed readings of every matching file (verdict columns included)."""
    return parse_rows(stage_cells(spark, path, glob), p, load_ts)


def apply_load_policy(parsed: DataFrame, policy: str = "CONTINUE") -> tuple[DataFrame, DataFrame]:
    """(loaded rows, rejected rows) under CONTINUE or SKIP_FILE."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    bad = F.col("is_bad")
    if policy == "CONTINUE":
        good = parsed.filter(~bad)
        rejected = parsed.filter(bad)
    else:
        bad_files = written(parsed.filter(bad).select("source_file").distinct(), "csv-bad-files")
        good = parsed.filter(~bad).join(bad_files, "source_file", "left_anti")
        rejected = (parsed.join(bad_files, "source_file", "left_semi")
                    .withColumn("bad_reason", F.coalesce("bad_reason", F.lit("file_skipped"))))
    return good.drop("is_bad", "bad_reason"), rejected


def load_report(parsed: DataFrame, policy: str = "CONTINUE", files: DataFrame | None = None) -> DataFrame:
    """Per file rows parsed, rows loaded and errors seen, with a status.

    ``files`` (source_file, loaded_at) adds the files of which no data row was parsed.
    """
    bad = F.col("is_bad").cast("int")
    per_file = parsed.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.sum(bad).cast("long").alias("errors_seen"),
        F.max("load_timestamp").alias("loaded_at"),
    )
    if files is not None:
        none = files.join(per_file, "source_file", "left_anti")
        per_file = per_file.unionByName(none.select("source_file", F.lit(0).cast("long").alias("rows_parsed"),
                                                    F.lit(0).cast("long").alias("errors_seen"), "loaded_at"))
    skip = policy == "SKIP_FILE"
    loaded = (F.when(F.col("errors_seen") > 0, F.lit(0).cast("long")).otherwise(F.col("rows_parsed"))
              if skip else F.col("rows_parsed") - F.col("errors_seen"))
    status = (F.when(F.col("errors_seen") == 0, "LOADED")
              .otherwise("LOAD_FAILED" if skip else "PARTIALLY_LOADED"))
    return per_file.select("source_file", "rows_parsed", loaded.alias("rows_loaded"), "errors_seen",
                           status.alias("status"), "loaded_at")


def load_totals(report: DataFrame) -> DataFrame:
    """I7 totals: files processed, rows loaded, errors seen."""
    return report.agg(F.count(F.lit(1)).alias("files_processed"),
                      F.sum("rows_loaded").cast("long").alias("rows_loaded"),
                      F.sum("errors_seen").cast("long").alias("errors_seen"))


def load_history(report: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """I7 history: report rows of files loaded in the ``hours`` before ``as_of``."""
    end = F.lit(str(as_of)).cast("timestamp_ntz")
    start = end - F.make_dt_interval(hours=F.lit(hours))
    return report.filter((F.col("loaded_at") > start) & (F.col("loaded_at") <= end))


def load_health_check(raw: DataFrame, min_ok: float = 30.0) -> DataFrame:
    """I8: per unit average/minimum health and readings, ok when average > ``min_ok``."""
    from ..functions.numeric import exact_avg, half_up

    # raw health is not yet rounded: round each value to 2 dp, then average exactly
    h2 = half_up("health_score", 2)
    agg = raw.select("equipment_id", h2.alias("_h")).groupBy("equipment_id").agg(
        half_up(exact_avg("_h", 2), 2).alias("avg_health"),
        F.min("_h").alias("min_health"),
        F.count(F.lit(1)).alias("readings"),
    )
    return agg.withColumn("health_ok", F.coalesce(F.col("avg_health") > min_ok, F.lit(False)))


# ----------------------------------------------------------------- writers

def with_event_date(raw: DataFrame) -> DataFrame:
    return raw.withColumn("event_date", F.to_date("timestamp"))


def write_raw(raw: DataFrame, out: str, mode: str = "append") -> None:
    """Raw readings as parquet partitioned by event date.

    The rebalance hint lets AQE size the write tasks: a heavy day is split
    over several tasks, small days are coalesced, and each task writes few
    date folders (not every task a file in every folder).

    ``overwrite`` replaces only the dates present in ``raw`` (dynamic
    partition overwrite), so a day can be reloaded without touching others.
    """
    (with_event_date(raw).hint("rebalance", "event_date").write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date").parquet(out))


def reload_raw(spark: SparkSession, src: str, out: str, glob: str = "*.csv", p: Params = DEFAULT,
               load_ts=None, policy: str = "CONTINUE") -> DataFrame:
    """Truncate and reload everything from the source files (sources kept)."""
    good, _ = apply_load_policy(read_sensor_csv(spark, src, glob, p, load_ts), policy)
    (with_event_date(good.select(*RAW_COLUMNS)).hint("rebalance", "event_date").write.mode("overwrite")
     .partitionBy("event_date").parquet(out))
    return spark.read.parquet(out)


def merge_batches(spark: SparkSession, src: str, out: str, glob: str = "*.csv",
                  p: Params = DEFAULT) -> DataFrame:
    """Combine all batch files into one parquet dataset."""
    good, _ = apply_load_policy(read_sensor_csv(spark, src, glob, p), "CONTINUE")
    good.select(*CSV_FIELDS).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def batch_names(raw: DataFrame) -> Column:
    """``batch_NNN_<day>_<next day>`` for the day of each reading (NNN from the first day)."""
    day = F.to_date("timestamp")
    first = raw.agg(F.min(F.to_date("timestamp"))).scalar()
    return F.format_string("batch_%03d_%s_%s", F.datediff(day, first) + 1,
                           F.date_format(day, "yyyyMMdd"), F.date_format(F.date_add(day, 1), "yyyyMMdd"))


def write_daily_batches(raw: DataFrame, out: str) -> None:
    """CSV files (with header) per 24 h batch, named ``<batch>_<n>.csv`` in a folder per batch.

    ``raw`` holds the nine CSV fields (typed or already as text); a ``batch``
    column, when present, names the batch, else it is derived from the day.
    Rows are rebalanced on the batch: small days land in one file, a heavy
    day is split over several tasks (and files) instead of one.
    """
    batch = F.col("batch") if "batch" in raw.columns else batch_names(raw)
    named = raw.select(*[F.col(f) for f in CSV_FIELDS], batch.alias("batch")).hint("rebalance", "batch")
    (named.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .partitionBy("batch").csv(out))
    name_batches(raw.sparkSession, out)


def name_batches(spark: SparkSession, out: str) -> int:
    """Names the part files of each ``batch=<name>`` folder ``<name>_<n>.csv``; returns how many got a name.

    Names only, no contents; files that have their name already are left, so a
    run that was cut short is finished by the next.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    top = hadoop(out)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    moved = 0
    for folder in fs.listStatus(top):
        name = folder.getPath().getName()
        if not name.startswith("batch="):
            continue
        batch = name.removeprefix("batch=")
        files = sorted(x.getPath().getName() for x in fs.listStatus(folder.getPath()))
        taken = sum(f.startswith(f"{batch}_") for f in files)
        for n, f in enumerate((f for f in files if f.startswith("part-")), taken + 1):
            fs.rename(hadoop(folder.getPath(), f), hadoop(folder.getPath(), f"{batch}_{n:03d}.csv"))
            moved += 1
    return moved
