
import os

from millstat.sources import csv_ingest as ci
from millstat.streaming import jobs as sp

HEADER = ",".join(ci.CSV_FIELDS)


def row(ts="2024-01-01 10:00:00", eid="Motor_001", etype="Motor", health="90.5", temp="45.0", vib="2.5",
        power="8.5", anomaly="0", reason=""):
    return ",".join([ts, eid, etype, health, temp, vib, power, anomaly, reason])


def write(dirpath, name, lines):
    path = os.path.join(dirpath, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))
    return path


def load(spark, d, policy="CONTINUE", glob="*.csv"):
    parsed = ci.read_sensor_csv(spark, d, glob=glob, load_ts="2024-02-01 00:00:00")
    good, rejected = ci.apply_load_policy(parsed, policy)
    return good, rejected


def test_continue_vs_skip_file(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [HEADER, row(), row(ts="not-a-time"), row(ts="2024-01-01 10:02:00")])
    write(tmp_dir, "batch_002.csv", [HEADER, row(ts="2024-01-02 10:00:00"), row(ts="2024-01-02 10:01:00")])
    good, rejected = load(spark, tmp_dir, "CONTINUE")
    assert good.count() == 4 and rejected.count() == 1
    good, rejected = load(spark, tmp_dir, "SKIP_FILE")
    assert good.count() == 2 and rejected.count() == 3


def test_header_in_another_order_maps_by_name(spark, tmp_dir):
    fields = list(reversed(ci.CSV_FIELDS))
    values = dict(zip(ci.CSV_FIELDS, row().split(",")))
    write(tmp_dir, "batch_001.csv", [",".join(fields), ",".join(values[f] for f in fields)])
    good, _ = load(spark, tmp_dir)
    r = good.first()
    assert (r.equipment_id, r.health_score, r.temperature, r.power_consumption) == ("Motor_001", 90.5, 45.0, 8.5)


def test_quoted_reason_with_comma(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [HEADER, row(anomaly="1", reason='"temperature_spike, vibration_spike"')])
    good, rejected = load(spark, tmp_dir)
    assert rejected.count() == 0
    assert good.first().anomaly_reason == "temperature_spike, vibration_spike"


def test_each_null_token_becomes_null_and_row_is_kept(spark, tmp_dir):
    lines = [HEADER] + [row(ts=f"2024-01-01 10:0{i}:00", temp=tok) for i, tok in
                        enumerate(["", "NULL", "null", "NaN", "nan"])]
    write(tmp_dir, "batch_001.csv", lines)
    good, rejected = load(spark, tmp_dir)
    assert rejected.count() == 0
    assert [r.temperature for r in good.collect()] == [None] * 5


def test_empty_file_and_blank_lines(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [])
    write(tmp_dir, "batch_002.csv", [HEADER, "", row(), "", ""])
    good, rejected = load(spark, tmp_dir)
    assert good.count() == 1 and rejected.count() == 0


def test_null_timestamp_long_id_and_field_count_are_bad(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [
        HEADER,
        row(ts=""),
        row(eid="X" * 51),
        row() + ",extra",
        row(ts="2024-01-01 11:00:00").rsplit(",", 1)[0],
        row(ts="2024-01-01 12:00:00"),
    ])
    parsed = ci.read_sensor_csv(spark, tmp_dir)
    reasons = sorted(r.bad_reason for r in parsed.filter("is_bad").collect())
    assert len(reasons) == 4
    assert any("null:timestamp" in r for r in reasons)
    assert any("too_long:equipment_id" in r for r in reasons)
    assert sum("malformed" in r for r in reasons) == 2
    assert parsed.filter("NOT is_bad").count() == 1


def test_file_without_header_is_rejected(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [row(), row(ts="2024-01-01 10:01:00")])
    good, rejected = load(spark, tmp_dir)
    assert good.count() == 0 and rejected.count() == 2


def test_glob_selects_batch_files(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [HEADER, row()])
    write(tmp_dir, "notes.csv", [HEADER, row(ts="2024-01-01 11:00:00")])
    good, _ = load(spark, tmp_dir, glob="*batch*.csv")
    assert good.count() == 1


def test_incremental_load_skips_seen_files(spark, tmp_dir):
    import datetime as dt

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    write(src, "batch_001.csv", [HEADER, row()])
    out, ledger = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "ledger")
    sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 1))
    write(src, "batch_002.csv", [HEADER, row(ts="2024-01-02 10:00:00")])
    report = sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 2))
    assert report.count() == 1
    assert spark.read.parquet(out).count() == 2
    sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 3))
    assert spark.read.parquet(out).count() == 2


def test_load_report_counts(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [HEADER, row(), row(ts="bad")])
    parsed = ci.read_sensor_csv(spark, tmp_dir)
    rep = ci.load_report(parsed, "SKIP_FILE").first()
    assert (rep.rows_parsed, rep.rows_loaded, rep.errors_seen, rep.status) == (2, 0, 1, "LOAD_FAILED")


def test_load_totals_and_history(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [HEADER, row(), row(ts="bad")])
    write(tmp_dir, "batch_002.csv", [HEADER, row(ts="2024-01-02 10:00:00")])
    parsed = ci.read_sensor_csv(spark, tmp_dir, load_ts="2024-02-01 06:00:00")
    report = ci.load_report(parsed, "CONTINUE")
    tot = ci.load_totals(report).first()
    assert (tot.files_processed, tot.rows_loaded, tot.errors_seen) == (2, 2, 1)
    assert ci.load_history(report, "2024-02-01 12:00:00", hours=24).count() == 2
    assert ci.load_history(report, "2024-02-01 12:00:00", hours=3).count() == 0


# ----------------------------------------------------------------- one parse, ledger

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_final_plans_have_no_csv_parse_and_no_exchange(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [HEADER, row(), row(ts="bad")])
    fields = list(reversed(ci.CSV_FIELDS))
    values = dict(zip(ci.CSV_FIELDS, row(ts="2024-01-02 10:00:00").split(",")))
    write(tmp_dir, "batch_002.csv", [",".join(fields), ",".join(values[f] for f in fields)])
    parsed = ci.read_sensor_csv(spark, tmp_dir, load_ts="2024-02-01 00:00:00")
    good, rejected = ci.apply_load_policy(parsed, "SKIP_FILE")
    assert good.count() == 1 and rejected.count() == 2
    for df in (parsed, *ci.apply_load_policy(parsed, "CONTINUE"), good, rejected):
        plan = _plan(df)
        assert "csv" not in plan.lower().replace("csv-", "") and "Exchange hashpartitioning" not in plan
        assert "SortMergeJoin" not in plan


def test_layouts_of_all_kinds_in_one_load(spark, tmp_dir):
    values = dict(zip(ci.CSV_FIELDS, row().split(",")))
    for n, shift in enumerate((0, 3, 5)):
        fields = ci.CSV_FIELDS[shift:] + ci.CSV_FIELDS[:shift]
        write(tmp_dir, f"batch_{n}.csv", [",".join(x.upper() for x in fields), ",".join(values[f] for f in fields)])
    write(tmp_dir, "batch_8.csv", [row()])
    write(tmp_dir, "batch_9.csv", [HEADER])
    parsed = ci.read_sensor_csv(spark, tmp_dir)
    good = ci.apply_load_policy(parsed)[0]
    assert {tuple(r)[1:8] for r in good.select(*ci.CSV_FIELDS).collect()} == {("Motor_001", "Motor", 90.5, 45.0, 2.5, 8.5, 0)}
    assert good.count() == 3
    assert [r.bad_reason.split(";")[0] for r in parsed.filter("is_bad").collect()] == ["no_header"]
    cells = ci.stage_cells(spark, tmp_dir)
    layouts = {r.source_file[-5]: r.file_layout for r in ci.file_layouts(cells).collect()}
    assert layouts["0"] == layouts["9"] == ci.STANDARD and layouts["8"] is None and layouts["1"] not in (None, ci.STANDARD)


def test_batches_get_their_names(spark, tmp_dir):
    rows = [(f"2024-01-0{d} 10:0{m}:00", "U1", "Motor", 90.0, 1.0, 1.0, 1.0, 0, None) for d in (1, 2) for m in range(3)]
    raw = spark.createDataFrame(rows, ", ".join(f"{f} string" if ci.FIELD_TYPES[f] in ("string", "timestamp_ntz") else
                                                f"{f} {ci.FIELD_TYPES[f]}" for f in ci.CSV_FIELDS))
    out = os.path.join(tmp_dir, "out")
    ci.write_daily_batches(raw.withColumn("timestamp", raw["timestamp"].cast("timestamp_ntz")), out)
    names = sorted(f for _, _, fs in os.walk(out) for f in fs if f.endswith(".csv"))
    assert names == ["batch_001_20240101_20240102_001.csv", "batch_002_20240102_20240103_001.csv"]
    assert ci.name_batches(spark, out) == 0
    assert load(spark, out, glob="*batch*.csv")[0].count() == 6


def test_ledger_enters_files_without_rows_and_bad_files(spark, tmp_dir):
    import datetime as dt

    src = os.path.join(tmp_dir, "src")
    os.makedirs(os.path.join(src, "sub"))
    write(src, "batch_001.csv", [HEADER])
    write(os.path.join(src, "sub"), "batch_002.csv", [HEADER, row(), row(ts="bad")])
    out, ledger = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "ledger")
    assert sp.load_entries(spark, ledger).count() == 0
    report = sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 1), policy="SKIP_FILE")
    assert {(r.source_file[-13:], r.rows_parsed, r.rows_loaded, r.status) for r in report.collect()} == {
        ("batch_001.csv", 0, 0, "LOADED"), ("batch_002.csv", 2, 0, "LOAD_FAILED")}
    assert sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 2)).count() == 0
    write(src, "batch_003.csv", [HEADER, row()])
    report = sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 3))
    assert [(r.rows_loaded, str(r.load_date)) for r in report.collect()] == [(1, "2024-02-03")]
    assert spark.read.parquet(out).count() == 1 and sp.load_entries(spark, ledger).count() == 3


def test_a_load_that_dies_before_its_entry_adds_nothing_twice(spark, tmp_dir, monkeypatch):
    import datetime as dt

    import pytest

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    write(src, "batch_001.csv", [HEADER, row(), row(ts="2024-01-02 10:00:00")])
    out, ledger = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "ledger")

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ci, "load_report", dies)
    with pytest.raises(Exception, match="lost"):
        sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 1))
    monkeypatch.undo()
    assert sp.load_entries(spark, ledger).count() == 0
    write(src, "batch_002.csv", [HEADER, row(ts="2024-01-03 10:00:00")])
    report = sp.load_new(spark, src, out, ledger, dt.date(2024, 2, 1))
    assert sum(r.rows_loaded for r in report.collect()) == 3
    assert spark.read.parquet(out).count() == 3


def test_report_with_files_of_no_rows(spark, tmp_dir):
    write(tmp_dir, "batch_001.csv", [HEADER])
    write(tmp_dir, "batch_002.csv", [HEADER, row()])
    cells = ci.stage_cells(spark, tmp_dir)
    from pyspark.sql import functions as F

    files = cells.select("source_file").distinct().withColumn("loaded_at", F.lit("2024-02-01").cast("timestamp_ntz"))
    report = ci.load_report(ci.parse_rows(cells), files=files)
    assert sorted(r.rows_parsed for r in report.collect()) == [0, 1]
