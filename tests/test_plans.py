"""Plan shape: what must (and must not) appear in the physical plans."""

import re

import pytest

from millstat.operators import staging
from millstat.plans import io_registry, registry
from millstat.sources import fixture

SF = "/root/testdata/sf0.001"
IO_KEYS = {name for name, e in registry.REGISTRY.items() if e.run.__module__ == io_registry.__name__}
BATCH_KEYS = sorted(set(registry.REGISTRY) - IO_KEYS)
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = plan_of(staging.stage(fixture.raw_readings(spark, SF)))
    exchange = plan.index("Exchange hashpartitioning(timestamp")
    limits = [(m.start(), plan[m.start():plan.index("\n", m.start())])
              for m in re.finditer("WindowGroupLimit", plan)]
    # printed top-down: the Final limit above the exchange, the Partial one below it
    assert any(pos < exchange and line.rstrip().endswith("Final") for pos, line in limits)
    assert any(pos > exchange and line.rstrip().endswith("Partial") for pos, line in limits)


def test_standalone_oee_reads_the_daily_table_not_the_readings(spark):
    plan = plan_of(registry.run("fact_oee", spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    # both branches (benchmark and rows) read the written equipment-day table;
    # the readings were scanned and deduplicated once, when it was written
    assert len(scans) == 2
    assert all("events.parquet" not in line for line in scans)
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_cartesian_or_python_stage(spark, key):
    plan = plan_of(registry.run(key, spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, (key, op)
