"""Parameters for every operator.

Nothing reads the clock: the reporting date, thresholds and expected
cadence are arguments, so a rebuild of the same input gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RangeLimits:
    """Physical limits of a staged reading; a reading outside is flagged.

    A NULL reading is never flagged.
    """

    temp_min: float = -50.0
    temp_max: float = 500.0
    vib_min: float = 0.0
    vib_max: float = 100.0
    power_min: float = 0.0
    health_min: float = 0.0
    health_max: float = 100.0


@dataclass(frozen=True)
class Params:
    # reporting date: "last N days" filters keep event_hour >= as_of - N days
    as_of: dt.date = dt.date(2024, 1, 30)
    lookback_days: int = 7
    limits: RangeLimits = field(default_factory=RangeLimits)
    # alternative policy (S8): readings outside these bounds become NULL
    null_temp_max: float = 100.0
    # OEE availability denominator: readings expected per equipment-day;
    # None: each unit's own cadence, estimated from its days (marts.expected_readings)
    expected_per_day: int | None = 1440
    # forecast: health at or below this is failure; lag span in daily rows
    critical_health: float = 30.0
    lag_span: int = 6
    # energy budget per day (same unit as total_power_kwh)
    daily_budget: float = 150.0
    # anomaly rule: spike threshold in sigmas by health band
    spike_sigma_healthy: float = 3.0
    spike_sigma_degrading: float = 2.0
    spike_sigma_critical: float = 1.5
    # query helpers
    overheat_temp: float = 60.0
    top_efficiency: int = 50
    top_high_power: int = 20
    # raw strings treated as NULL when a CSV is loaded
    null_tokens: tuple[str, ...] = ("", "NULL", "null", "NaN", "nan")
    # string length limits enforced at load (VARCHAR sizes of the raw table)
    max_id_len: int = 50
    max_type_len: int = 50
    max_reason_len: int = 200
    # file ledger memory for incremental loads
    ledger_days: int = 64

    def with_(self, **kw) -> "Params":
        from dataclasses import replace

        return replace(self, **kw)


DEFAULT = Params()
