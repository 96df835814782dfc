"""Mart build (I13), row counts (I9) and the work-order export sink.

Staging is computed once per build and written to the build folder, so
the four marts read the deduplicated readings instead of re-running the
dedup shuffle four times; the three daily marts also share one
equipment-day aggregate, itself written once. Marts are written
partitioned by event date, which is what the report queries prune on.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, staging
from ..params import DEFAULT, Params

MARTS = ("energy", "alert", "oee", "forecast")


def build_marts(spark: SparkSession, raw: DataFrame, out: str, p: Params = DEFAULT,
                select: tuple[str, ...] = MARTS) -> dict[str, str]:
    """Full rebuild of staging and the selected marts under ``out``.

    Returns table name -> path. Intermediate results are written (not
    cached), so a lost executor only recomputes from the last written table.
    Independent writes run as concurrent jobs: energy next to the
    equipment-day table, then alert, OEE and forecast together.
    """
    unknown = set(select) - set(MARTS)
    if unknown:
        raise ValueError(f"unknown marts: {sorted(unknown)}")
    paths = {"stg": f"{out}/stg"}
    stg = staging.stage(raw, p)
    stg.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(paths["stg"])
    stg = spark.read.parquet(paths["stg"])

    def write_energy() -> None:
        (with_build_time(marts.fact_energy(stg, p)).hint("rebalance", "event_date").write.mode("overwrite")
         .partitionBy("event_date").parquet(paths["energy"]))

    def write_daily_marts() -> None:
        marts.daily_equipment(stg).write.mode("overwrite").parquet(paths["daily"])
        daily = spark.read.parquet(paths["daily"])
        builders = {"alert": marts.alert_maintenance, "oee": marts.fact_oee, "forecast": marts.fact_forecast}

        def write_one(m: str) -> None:
            df = with_build_time(builders[m](stg, p, daily))
            if "event_date" in df.columns:
                writer = df.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date")
            else:
                writer = df.write.mode("overwrite")
            writer.parquet(paths[m])

        _run_all([lambda m=m: write_one(m) for m in daily_marts])

    jobs = []
    if "energy" in select:
        paths["energy"] = f"{out}/energy"
        jobs.append(write_energy)
    daily_marts = [m for m in ("alert", "oee", "forecast") if m in select]
    if daily_marts:
        paths["daily"] = f"{out}/daily"
        paths.update({m: f"{out}/{m}" for m in daily_marts})
        jobs.append(write_daily_marts)
    _run_all(jobs)
    return paths


# View names under which a build is exposed, the table names the
# reference's queries use, so those queries run unchanged.
VIEW_NAMES = {"stg": "stg_sensor_raw", "energy": "fact_energy_consumption", "alert": "alert_predictive_maintenance",
              "oee": "fact_oee", "forecast": "fact_forecasting", "daily": "daily_equipment"}


def register_views(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """Expose a finished build as temp views (one per written table) for SQL users."""
    names = []
    for table, path in paths.items():
        name = VIEW_NAMES.get(table, table)
        spark.read.parquet(path).createOrReplaceTempView(name)
        names.append(name)
    return names


def staging_view(spark: SparkSession, raw: DataFrame, p: Params = DEFAULT, name: str = "stg_sensor_raw") -> DataFrame:
    """Staging as a lazy view: nothing runs until a query reads it."""
    stg = staging.stage(raw, p)
    stg.createOrReplaceTempView(name)
    return stg


def _run_all(jobs) -> None:
    """Run independent Spark jobs concurrently; re-raise the first failure."""
    if len(jobs) <= 1:
        for job in jobs:
            job()
        return
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for future in [pool.submit(job) for job in jobs]:
            future.result()


def with_build_time(df: DataFrame) -> DataFrame:
    """The volatile build timestamp column, added only when a mart is written."""
    return df.withColumn("dbt_updated_at", F.current_timestamp().cast("timestamp_ntz"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every given table, one union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_export(alerts_export: DataFrame, path: str, fmt: str = "csv") -> None:
    """I14 sink: the work-order export as CSV (with header) or parquet."""
    writer = alerts_export.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
