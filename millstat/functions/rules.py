"""Rule tables turned into CASE chains.

Each table is an ordered list of (label, action, predicate-builder); the
first matching row wins and the last row is the default. The same table
drives both the label and its action text, so they can never disagree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Daily risk levels and their action texts, in rule order.
RISK_LEVELS = [
    ("CRITICAL", "IMMEDIATE INSPECTION REQUIRED", 30.0, 20.0),
    ("WARNING", "Schedule maintenance within 48 hours", 60.0, 10.0),
    ("WATCH", "Monitor closely - schedule next maintenance window", 80.0, 5.0),
]
RISK_DEFAULT = ("NORMAL", "No action required")

# OEE classes by minimum score (product * 100), in rule order.
OEE_CLASSES = [("WORLD CLASS", 85.0), ("GOOD", 65.0), ("FAIR", 50.0)]
OEE_DEFAULT = "POOR"

# Forecast urgency levels and action texts, in rule order.
URGENCY_NOW = ("CRITICAL NOW", "STOP MACHINE — Immediate inspection required")
URGENCY_STABLE = ("STABLE", "No failure predicted — Continue monitoring")
URGENCY_BY_DAYS = [
    ("CRITICAL", "Schedule emergency maintenance TODAY", 3.0),
    ("HIGH", "Schedule maintenance within this week", 7.0),
    ("MEDIUM", "Plan maintenance in next 2 weeks", 14.0),
]
URGENCY_DEFAULT = ("LOW", "No immediate action — Monitor monthly")
# display order of urgency levels (anything else sorts last)
URGENCY_RANK = ["CRITICAL NOW", "CRITICAL", "HIGH", "MEDIUM", "LOW"]

# Row-level severity bands on health (upper bounds, exclusive).
SEVERITY_BANDS = [("CRITICAL", 30.0), ("HIGH", 50.0), ("MEDIUM", 70.0)]
SEVERITY_DEFAULT = "LOW"

# Health -> reason band (above 70 none, then bands that include their lower bound).
HEALTH_BANDS = [
    (70.0, None),
    (50.0, "equipment_degrading"),
    (30.0, "poor_equipment_condition"),
]
HEALTH_BAND_DEFAULT = "critical_equipment_failure"

# KPI traffic-light bands (green at or above, amber at or above).
KPI_BANDS = {
    "oee": (85.0, 65.0),
    "availability": (90.0, 75.0),
    "performance": (90.0, 75.0),
    "quality": (95.0, 85.0),
}

# Combined-symptom maintenance actions, in rule order.
CAUSE_ACTIONS = [
    ("CRITICAL", "Replace bearing immediately"),       # vibration + declining
    ("HIGH", "Schedule preventive servicing"),        # temperature + power spike
    ("HIGH", "Increase inspection frequency"),        # decline >= 2 per day
    ("MEDIUM", "Record in maintenance log"),          # minor anomalies
]
CAUSE_DEFAULT = ("LOW", "Continue monitoring")


def chain(cases: list[tuple[Column, object]], default) -> Column:
    """CASE WHEN c1 THEN v1 ... ELSE default END."""
    out = None
    for cond, value in cases:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def risk_columns(min_health: Column, rate: Column) -> tuple[Column, Column]:
    conds = [(min_health < lim_h) | (rate > lim_r) for _, _, lim_h, lim_r in RISK_LEVELS]
    level = chain(list(zip(conds, [r[0] for r in RISK_LEVELS])), RISK_DEFAULT[0])
    action = chain(list(zip(conds, [r[1] for r in RISK_LEVELS])), RISK_DEFAULT[1])
    return level, action


def oee_class(product_pct: Column) -> Column:
    return chain([(product_pct >= lim, name) for name, lim in OEE_CLASSES], OEE_DEFAULT)


def urgency_columns(health: Column, days: Column, critical: float) -> tuple[Column, Column]:
    conds = [health <= critical, days.isNull() | (days < 0)]
    conds += [days <= lim for _, _, lim in URGENCY_BY_DAYS]
    labels = [URGENCY_NOW[0], URGENCY_STABLE[0]] + [u[0] for u in URGENCY_BY_DAYS]
    actions = [URGENCY_NOW[1], URGENCY_STABLE[1]] + [u[1] for u in URGENCY_BY_DAYS]
    level = chain(list(zip(conds, labels)), URGENCY_DEFAULT[0])
    action = chain(list(zip(conds, actions)), URGENCY_DEFAULT[1])
    return level, action


def urgency_rank(level: Column) -> Column:
    return chain([(level == name, i + 1) for i, name in enumerate(URGENCY_RANK)],
                 len(URGENCY_RANK) + 1)


def severity(health: Column) -> Column:
    return chain([(health < lim, name) for name, lim in SEVERITY_BANDS], SEVERITY_DEFAULT)


def health_band(health: Column) -> Column:
    cases = [((health > lim, F.lit(None).cast("string")) if r is None else (health >= lim, r))
             for lim, r in HEALTH_BANDS]
    return chain(cases, HEALTH_BAND_DEFAULT)


def kpi_status(value: Column, kpi: str) -> Column:
    green, amber = KPI_BANDS[kpi]
    return chain([(value >= green, "GREEN"), (value >= amber, "AMBER")], "RED")
