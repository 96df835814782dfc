"""Random small inputs: Spark staging + energy mart against a plain-Python brute force."""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest

from conftest import make_raw
from millstat.operators import marts, staging


def hu(x, n):
    if x is None:
        return None
    s = float(10 ** n)
    sign = (x > 0) - (x < 0)
    return (sign * math.floor(abs(x) * s + 0.5)) / s


def out_of_range(r):
    def bad(v, lo, hi):
        return v is not None and ((lo is not None and v < lo) or (hi is not None and v > hi))
    return (bad(r["temperature"], -50, 500) or bad(r["vibration"], 0, 100)
            or bad(r["power_consumption"], 0, None) or bad(r["health_score"], 0, 100))


def exact_avg(vals, n):
    vals = [v for v in vals if v is not None]
    if not vals:
        return None
    s = float(10 ** n)
    return (float(sum(int(round(v * s)) for v in vals)) / s) / len(vals)


def brute_energy(rows):
    best = {}
    for r in rows:
        if r["timestamp"] is None or r["equipment_id"] is None:
            continue
        k = (r["timestamp"], r["equipment_id"])
        rank = (r["load_timestamp"] is None, r["load_timestamp"] or dt.datetime.min, r["event_id"])
        if k not in best or rank > best[k][0]:
            best[k] = (rank, r)
    groups = defaultdict(list)
    for _, r in best.values():
        if out_of_range(r):
            continue
        hour = r["timestamp"].replace(minute=0, second=0, microsecond=0)
        groups[(hour, r["equipment_id"], r["equipment_type"])].append(r)
    out = {}
    for (hour, unit, etype), rs in groups.items():
        power = [hu(r["power_consumption"], 2) for r in rs]
        temp = [hu(r["temperature"], 2) for r in rs]
        health = [hu(r["health_score"], 2) for r in rs]
        p_nn = [v for v in power if v is not None]
        out[(hour, unit)] = dict(
            total_power_kwh=hu(float(sum(int(round(v * 100)) for v in p_nn)) / 100.0, 2) if p_nn else None,
            avg_power_kw=hu(exact_avg(power, 2), 2),
            avg_temperature_c=hu(exact_avg(temp, 2), 2),
            min_health_score=min((v for v in health if v is not None), default=None),
            reading_count=len(rs),
        )
    return out


def random_rows(seed, n=300):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        def num(lo, hi, digits=3):
            return None if rng.random() < 0.08 else round(rng.uniform(lo, hi), digits)
        rows.append(dict(
            timestamp=t0 + dt.timedelta(minutes=rng.randrange(0, 180)),
            equipment_id=rng.choice(["Motor_001", "Chiller_001", None if rng.random() < 0.05 else "Motor_002"]),
            equipment_type="Motor",
            health_score=num(-5, 105),
            temperature=num(-60, 120),
            vibration=num(-1, 10, 4),
            power_consumption=num(-1, 20),
            is_anomaly=rng.choice([0, 1]),
            load_timestamp=None if rng.random() < 0.1 else t0 + dt.timedelta(seconds=rng.randrange(0, 50)),
            event_id=i,
        ))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_energy_matches_brute_force(spark, seed):
    rows = random_rows(seed)
    raw = make_raw(spark, rows)
    got = {(r.event_hour, r.equipment_id): r for r in marts.fact_energy(staging.stage(raw)).collect()}
    want = brute_energy(rows)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        for col, v in w.items():
            assert getattr(g, col) == v, (k, col, getattr(g, col), v)
