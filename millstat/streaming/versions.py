"""Partitioned tables whose partitions are replaced by version, pointer last.

Layout under the table's folder:

* ``rows/version=N/event_date=D/``: the rows of a partition as version N;
* ``log/``: one row (version, event_date) for each partition that version N
  replaces, appended after its rows are written.

The newest logged version of a date holds. Rows of a version that is not in
the log do not exist for a reader, so a job that dies between the rows and
the log has changed nothing; when it runs again as the same version it writes
the same folders again. A writer of version N reads only older versions,
so it never overwrites what it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "version long, event_date date"


def read_or_none(spark: SparkSession, path: str, schema=None, base: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing was written there. ``base``: folder of a table of which ``path`` is a partition."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return (reader if base is None else reader.option("basePath", base)).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


class VersionedTable:
    """Rows by ``event_date`` with one current version for each date."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.rows_path, self.log_path = f"{path}/rows", f"{path}/log"

    def log(self) -> DataFrame:
        found = read_or_none(self.spark, self.log_path, LOG_SCHEMA)
        return self.spark.createDataFrame([], LOG_SCHEMA) if found is None else found

    def last_version(self) -> int:
        """The newest version in the log, -1 before the first."""
        return self.log().agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]

    def pointers(self, before: int | None = None) -> DataFrame:
        """Current version of each date, or the one that held before version ``before``."""
        log = self.log() if before is None else self.log().where(F.col("version") < before)
        return log.groupBy("event_date").agg(F.max("version").alias("version"))

    def current(self, before: int | None = None) -> DataFrame | None:
        """The rows that hold (before version ``before``); None if no version was ever written."""
        rows = read_or_none(self.spark, self.rows_path)
        if rows is None:
            return None
        rows = rows.withColumn("version", F.col("version").cast("long"))
        return rows.join(self.pointers(before), ["event_date", "version"], "left_semi").drop("version")

    def publish(self, rows: DataFrame, version: int, dates: DataFrame) -> None:
        """Replaces ``dates`` (event_date) by ``rows``; a date without rows becomes empty.

        ``dates`` is written last and must not depend on this version.
        """
        (rows.withColumn("version", F.lit(version).cast("long")).hint("rebalance", "event_date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("version", "event_date").parquet(self.rows_path))
        self._point(version, dates)

    def _point(self, version: int, dates: DataFrame) -> None:
        (dates.select(F.lit(version).cast("long").alias("version"), "event_date").distinct()
         .coalesce(1).write.mode("append").parquet(self.log_path))

    def expire(self) -> int:
        """Deletes the folders of versions that hold for no date; returns how many were deleted.

        Not to be called while a reader of an older version is running.
        """
        rows = read_or_none(self.spark, self.rows_path)
        if rows is None:
            return 0
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        top = hadoop(self.rows_path)
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        held = {r["version"] for r in self.pointers().select("version").distinct().toLocalIterator()}
        last, gone = self.last_version(), 0
        for status in fs.listStatus(top):
            name = status.getPath().getName()
            if name.startswith("version="):
                version = int(name.removeprefix("version="))
                if version <= last and version not in held:  # newer ones may be about to be logged
                    fs.delete(status.getPath(), True)
                    gone += 1
        return gone
