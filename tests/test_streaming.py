"""Stream behaviour: exactly-once files, latest wins, stream equals batch."""

import datetime as dt
import os
import random
import time

import pytest

from pyspark.sql import functions as F

from millstat.operators import marts, staging
from millstat.plans.registry import Frames
from millstat.sources import csv_ingest as ci
from millstat.streaming import jobs as sp
from millstat.streaming.versions import VersionedTable
from test_ingest import HEADER, row, write

SF = "/root/testdata/sf0.001"


def _set_mtime(path, when):
    ts = time.mktime(when.timetuple())
    os.utime(path, (ts, ts))


def test_rerun_adds_nothing_and_renamed_content_is_ignored(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    p1 = write(src, "batch_001.csv", [HEADER, row(), row(ts="2024-01-01 10:01:00")])
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    sp.stream_raw(spark, f"{src}/*.csv", out, ckpt)
    assert spark.read.parquet(out).count() == 2
    sp.stream_raw(spark, f"{src}/*.csv", out, ckpt)
    assert spark.read.parquet(out).count() == 2
    # same name, changed content: the file log already has it
    write(src, "batch_001.csv", [HEADER, row(ts="2024-01-01 11:00:00")])
    _set_mtime(p1, dt.datetime(2030, 1, 1))
    sp.stream_raw(spark, f"{src}/*.csv", out, ckpt)
    assert spark.read.parquet(out).count() == 2


def same_rows(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ----------------------------------------------------------------- T1

def test_latest_file_wins_and_inside_a_file_the_last_row(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    a = write(src, "batch_001.csv", [HEADER, row(health="10.0"), row(ts="2024-01-01 10:01:00", health="11.0"),
                                     row(ts="2024-01-01 10:02:00", health="12.0"), row(health="13.0"),
                                     row(ts="2024-01-01 10:02:00", health="14.0"), row(ts="2024-01-02 10:02:00", health="15.0")])
    _set_mtime(a, dt.datetime(2024, 1, 1, 12))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    sp.stream_latest(spark, f"{src}/*.csv", out, ckpt)
    assert {(str(r.timestamp), r.health_score) for r in sp.latest_readings(spark, out).collect()} == {
        ("2024-01-01 10:00:00", 13.0), ("2024-01-01 10:01:00", 11.0), ("2024-01-01 10:02:00", 14.0), ("2024-01-02 10:02:00", 15.0)}
    b = write(src, "batch_002.csv", [HEADER, row(health="20.0"), row(health="21.0")])
    _set_mtime(b, dt.datetime(2024, 1, 2, 12))
    older = write(src, "batch_003.csv", [HEADER, row(health="30.0"), row(ts="2024-01-03 10:00:00", health="31.0")])
    _set_mtime(older, dt.datetime(2024, 1, 1, 11))
    sp.stream_latest(spark, f"{src}/*.csv", out, ckpt)
    assert {(str(r.timestamp), r.health_score) for r in sp.latest_readings(spark, out).collect()} == {
        ("2024-01-01 10:00:00", 21.0), ("2024-01-01 10:01:00", 11.0), ("2024-01-01 10:02:00", 14.0),
        ("2024-01-02 10:02:00", 15.0), ("2024-01-03 10:00:00", 31.0)}


def test_order_inside_a_file_of_many_splits(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    lines = [row(ts=f"2024-01-01 10:{i % 60:02d}:00", health=f"{i % 100}.25", power=f"{i}.5") for i in range(3000)]
    write(src, "batch_001.csv", [HEADER, *lines])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        out = os.path.join(tmp_dir, "out")
        sp.stream_latest(spark, f"{src}/*.csv", out, os.path.join(tmp_dir, "ckpt"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    got = {r.timestamp.minute: r.power_consumption for r in sp.latest_readings(spark, out).collect()}
    assert got == {m: 2940 + m + 0.5 for m in range(60)}


def test_all_bad_batch_and_no_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    assert sp.latest_readings(spark, out).count() == 0
    write(src, "batch_001.csv", [HEADER, row(ts="bad")])
    sp.stream_latest(spark, f"{src}/*.csv", out, ckpt)
    assert sp.latest_readings(spark, out).count() == 0
    write(src, "batch_002.csv", [HEADER, row()])
    sp.stream_latest(spark, f"{src}/*.csv", out, ckpt)
    assert sp.latest_readings(spark, out).count() == 1


@pytest.mark.parametrize("where", ["before the log", "after the log"])
def test_replay_after_a_failure_gives_the_same_table(spark, tmp_dir, monkeypatch, where):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    a = write(src, "batch_001.csv", [HEADER, row(health="10.0"), row(ts="2024-01-01 10:01:00", health="11.0")])
    _set_mtime(a, dt.datetime(2024, 1, 1, 12))
    sp.stream_latest(spark, f"{src}/*.csv", out, ckpt)
    before = sorted(sp.latest_readings(spark, out).collect())
    b = write(src, "batch_002.csv", [HEADER, row(health="20.0"), row(ts="2024-01-02 10:01:00", health="22.0")])
    _set_mtime(b, dt.datetime(2024, 1, 2, 12))
    point = VersionedTable._point

    def dies(self, version, dates):
        if where == "after the log":
            point(self, version, dates)
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionedTable, "_point", dies)
    with pytest.raises(Exception, match="lost"):
        sp.stream_latest(spark, f"{src}/*.csv", out, ckpt)
    if where == "before the log":  # a reader sees nothing of the batch
        assert sorted(sp.latest_readings(spark, out).collect()) == before
    monkeypatch.undo()
    sp.stream_latest(spark, f"{src}/*.csv", out, ckpt)
    assert {(str(r.timestamp), r.health_score) for r in sp.latest_readings(spark, out).collect()} == {
        ("2024-01-01 10:00:00", 20.0), ("2024-01-01 10:01:00", 11.0), ("2024-01-02 10:01:00", 22.0)}


def test_expire_keeps_what_holds(spark, tmp_dir):
    table = VersionedTable(spark, os.path.join(tmp_dir, "t"))
    rows = lambda d, v: spark.createDataFrame([(dt.date(2024, 1, d), v)], "event_date date, v int")
    for version, (day, value) in enumerate([(1, 10), (2, 20), (1, 11), (1, 12)]):
        table.publish(rows(day, value), version, rows(day, value).select("event_date"))
    assert sorted(r["v"] for r in table.current().collect()) == [12, 20]
    assert sorted(r["v"] for r in table.current(before=3).collect()) == [11, 20]
    assert table.expire() == 2
    assert sorted(r["v"] for r in table.current().collect()) == [12, 20]
    table.publish(rows(1, 0).limit(0), 4, rows(1, 0).select("event_date"))
    assert [r["v"] for r in table.current().collect()] == [20]


# ----------------------------------------------------------------- T3

def test_alerts_equal_batch_after_every_batch(spark, tmp_dir):
    """Random loads of the same readings: values come and go, extremes among them, types and ranges change."""
    rng = random.Random(4)
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    raw_out, alerts_out, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "alerts", "ckpt"))
    assert sp.current_alerts(spark, alerts_out) is None
    loaded = []
    for k in range(5):
        lines = []
        for _ in range(rng.choice([3, 25, 60])):
            ts = f"2024-01-0{rng.randint(1, 3)} 10:0{rng.randint(0, 7)}:00"
            lines.append(row(ts=ts, eid=f"U{rng.randint(1, 2)}", etype=rng.choice(["Motor", "Motor", "Chiller", ""]),
                             health=rng.choice(["", "10.25", "55.5", "90.0", "101.0"]), temp=rng.choice(["", "20.5", "80.0", "999.0"]),
                             vib=rng.choice(["", "0.5", "9.75"]), power=rng.choice(["", "1.5", "8.25"]), anomaly=rng.choice(["0", "1", ""])))
        path = write(src, f"batch_{k}.csv", [HEADER, *lines])
        _set_mtime(path, dt.datetime(2024, 2, 1, 12, k))
        loaded += lines
        sp.stream_alerts(spark, f"{src}/*.csv", raw_out, alerts_out, ckpt)
        full = write(tmp_dir, f"all_{k}.csv", [HEADER, *loaded])
        raw, _ = ci.apply_load_policy(ci.parse_rows(ci.with_positions(ci.read_rows(spark, full))))
        batch = marts.alert_maintenance(staging.stage(raw, tie_breakers=sp.load_order()))
        assert same_rows(sp.current_alerts(spark, alerts_out), batch)


def test_a_superseded_extreme_reads_its_day_again_only_there(spark, tmp_dir, monkeypatch):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    raw_out, alerts_out, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "alerts", "ckpt"))
    a = write(src, "b1.csv", [HEADER, row(temp="90.0"), row(ts="2024-01-01 10:01:00", temp="50.0"),
                              row(eid="Motor_002", temp="70.0"), row(eid="Motor_002", ts="2024-01-01 10:01:00", temp="60.0")])
    _set_mtime(a, dt.datetime(2024, 1, 1, 12))
    sp.stream_alerts(spark, f"{src}/*.csv", raw_out, alerts_out, ckpt)
    again = []
    state = sp._merged_state

    def spy(old, terms):
        if old is None:
            again.append(terms)
        return state(old, terms)

    monkeypatch.setattr(sp, "_merged_state", spy)
    b = write(src, "b2.csv", [HEADER, row(temp="40.0"), row(eid="Motor_002", temp="75.0")])
    _set_mtime(b, dt.datetime(2024, 1, 2, 12))
    sp.stream_alerts(spark, f"{src}/*.csv", raw_out, alerts_out, ckpt)
    got = {r.equipment_id: (r.max_temperature_c, r.total_readings) for r in sp.current_alerts(spark, alerts_out).collect()}
    assert got == {"Motor_001": (50.0, 2), "Motor_002": (75.0, 2)}
    assert {r.equipment_id for r in again[-1].collect()} == {"Motor_001"}


# ----------------------------------------------------------------- T2

def _staged_days(spark, tmp_dir):
    f = Frames(spark, SF)
    path = os.path.join(tmp_dir, "stg")
    staging.valid_only(f.stg).write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path), os.path.join(tmp_dir, "staged"), marts.fact_energy(f.stg)


def _add(stg, staged):
    stg.coalesce(1).write.mode("append").partitionBy("event_date").parquet(staged)


def test_stream_energy_equals_the_batch_on_all_hours(spark, tmp_dir):
    stg, staged, batch = _staged_days(spark, tmp_dir)
    _add(stg, staged)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    run = sp.stream_energy(spark, staged, out, ckpt, late="fail")
    assert run.late_readings == 0 and run.open_readings > 0
    assert run.closed_readings + run.open_readings == stg.count()
    assert same_rows(sp.energy(spark, out), batch)
    assert spark.read.parquet(f"{out}/closed").count() < batch.count()
    assert sp.stream_energy(spark, staged, out, ckpt, late="fail").hours_recomputed == 0  # nothing new
    assert same_rows(sp.energy(spark, out), batch)


def test_stream_energy_newest_day_first_with_late_files(spark, tmp_dir):
    stg, staged, batch = _staged_days(spark, tmp_dir)
    days = [r[0] for r in stg.select("event_date").distinct().orderBy(F.desc("event_date")).collect()][:4]
    stg = stg.where(F.col("event_date") >= days[-1])
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    late = 0
    for part in (days[:2], days[2:]):
        _add(stg.where(F.col("event_date").isin(part)), staged)
        late = sp.stream_energy(spark, staged, out, ckpt, max_files=1).late_readings
        assert same_rows(sp.energy(spark, out), batch.where(F.col("event_date") >= min(part)))
    assert late >= stg.where(F.col("event_date") < days[1]).count() > 0


def test_late_readings_fail_or_are_left_out(spark, tmp_dir):
    stg, staged, batch = _staged_days(spark, tmp_dir)
    last = stg.agg(F.max("event_date")).first()[0]
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    _add(stg.where(F.col("event_date") == last), staged)
    sp.stream_energy(spark, staged, out, ckpt)
    held = sp.energy(spark, out).count()
    _add(stg.where(F.col("event_date") == dt.date(2024, 1, 1)), staged)
    with pytest.raises(sp.LateReadings):
        sp.stream_energy(spark, staged, out, ckpt, late="fail")
    assert sp.energy(spark, out).count() == held
    run = sp.stream_energy(spark, staged, out, ckpt, late="allow")
    assert run.late_readings > 0 and sp.energy(spark, out).count() == held
    sp.stream_energy(spark, staged, out, ckpt)  # repairs what was left out
    assert same_rows(sp.energy(spark, out), batch.where(F.col("event_date").isin(last, dt.date(2024, 1, 1))))
    with pytest.raises(ValueError):
        sp.stream_energy(spark, staged, out, ckpt, late="maybe")


def test_open_hours_leave_the_overlay_when_they_close(spark, tmp_dir):
    stg, staged, batch = _staged_days(spark, tmp_dir)
    days = [r[0] for r in stg.select("event_date").distinct().orderBy("event_date").collect()]
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    for day in days[:2]:
        _add(stg.where(F.col("event_date") == day), staged)
        assert sp.stream_energy(spark, staged, out, ckpt, late="fail").late_readings == 0
        assert same_rows(sp.energy(spark, out), batch.where(F.col("event_date") <= day))
    overlay = VersionedTable(spark, f"{out}/overlay").current()
    assert {r[0] for r in overlay.select("event_date").distinct().collect()} == {days[1]}


def test_build_marts_and_export(spark, tmp_dir):
    from millstat.plans import build
    from millstat.plans import maintenance_reports as R

    f = Frames(spark, SF)
    paths = build.build_marts(spark, f.raw, os.path.join(tmp_dir, "wh"), select=("alert", "energy"))
    assert set(paths) == {"stg", "energy", "daily", "alert"}
    alerts = spark.read.parquet(paths["alert"])
    assert "dbt_updated_at" in alerts.columns
    assert alerts.count() == marts.alert_maintenance(f.stg).count()
    out = os.path.join(tmp_dir, "export")
    exported = R.export_alerts(alerts)
    build.write_export(exported, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == exported.count()
    assert back.filter(F.col("work_order_id").isNotNull()).count() == 0


def test_build_views_are_queryable(spark, tmp_dir):
    from millstat.plans import build

    f = Frames(spark, SF)
    build.staging_view(spark, f.raw)
    assert spark.sql("SELECT count(*) FROM stg_sensor_raw").first()[0] == f.stg.count()
    paths = build.build_marts(spark, f.raw, os.path.join(tmp_dir, "wh"), select=("energy",))
    names = build.register_views(spark, paths)
    assert "fact_energy_consumption" in names
    got = spark.sql("SELECT sum(reading_count) FROM fact_energy_consumption").first()[0]
    assert got == f.stg.filter("NOT is_out_of_range").count()


@pytest.mark.parametrize("key", ["energy_by_type", "risk_distribution", "failure_timeline", "oee_kpis"])
def test_reports_on_a_build_equal_reports_from_raw(spark, tmp_dir, key):
    from millstat.plans import build, registry

    e = registry.REGISTRY[key]
    f = Frames(spark, SF, e.params)
    paths = build.build_marts(spark, f.raw, os.path.join(tmp_dir, "wh"), e.params)
    on_build = registry.run_on_build(key, registry.BuiltFrames(spark, paths, e.params))
    from_raw = registry.run(key, spark, SF)
    cols = sorted(from_raw.columns)
    assert sorted(on_build.select(*cols).collect()) == sorted(from_raw.select(*cols).collect())


def test_stream_energy_is_independent_of_the_session_zone(spark, tmp_dir):
    f = Frames(spark, SF)
    batch = marts.fact_energy(f.stg)
    cols = sorted(batch.columns)
    expected = sorted(batch.select(*cols).collect())
    staged = os.path.join(tmp_dir, "staged")
    staging.valid_only(f.stg).write.parquet(staged)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
        sp.stream_energy(spark, staged, out, ckpt, max_files=100)
        got = sp.energy(spark, out).select(*cols).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(got) == expected
