"""Bench: headline work at $BENCH_SF_DIR on local[$BENCH_CPUS].

Uses the scale-out fixture (one unit per user). Three parts, each the
median of $BENCH_RUNS warm runs, nothing collected (no-op sink):
* ``build_marts``: raw readings -> staging -> four marts, written as
  parquet (the reference's model build);
* report queries over the written marts (what dashboards run);
* end-to-end keys computed from the raw events in one plan.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millstat.plans import build, registry  # noqa: E402
from millstat.session import local_session, scratch_path  # noqa: E402

REPORTS = [
    "energy_by_type", "hourly_trend", "energy_by_equipment", "peak_hour", "temp_efficiency_top50",
    "daily_budget", "high_power_top20", "energy_share", "period_rollup", "energy_health_join",
    "open_alerts", "risk_distribution", "risk_vs_maxima", "anomaly_leaderboard", "kpi_targets",
    "failure_timeline", "oee_kpis", "oee_by_equipment", "kpi_status", "executive_overview",
    "dq_energy_rules", "missing_hours",
]
END_TO_END = ["stg_sensor", "fact_energy", "alert_maintenance", "fact_oee", "fact_forecast", "cause_rules",
              "dq_report"]


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times: dict[str, float] = {}

    built: dict[str, str] = {}

    def do_build() -> None:
        raw = registry.Frames(spark, sf_dir, scale_out=True).raw
        built.update(build.build_marts(spark, raw, scratch_path(spark, "bench-warehouse")))

    times["build_marts"] = timed(do_build, runs)
    # the marts are opened once per session (as a dashboard would), then queried
    opened: dict = {}
    for key in REPORTS:
        e = registry.REGISTRY[key]
        frames = opened.setdefault(e.params, registry.BuiltFrames(spark, dict(built), e.params, sf_dir))
        times[key] = timed(lambda key=key, frames=frames: noop(registry.run_on_build(key, frames)), runs)
    for key in END_TO_END:
        times[f"e2e_{key}"] = timed(lambda k=key: noop(registry.run(k, spark, sf_dir, scale_out=True)), runs)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
