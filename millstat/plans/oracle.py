"""Independent SQL twin of the pipeline, for DuckDB (the correctness oracle).

The driver registers the parquet tables as views; each oracle query is a
WITH chain (events -> raw -> staged -> marts) plus one final SELECT. Only
the fixed values (unit table, sensor spec, rule tables, key format) are
shared with the Spark side; the logic is written out again in SQL.
"""

from __future__ import annotations

from ..functions import keys, rules
from ..operators.anomaly import SENSORS, SPEC
from ..params import DEFAULT, Params
from ..sources.fixture import EPOCH, UNITS


# ----------------------------------------------------------------- numeric text

def hu(x: str, n: int) -> str:
    """half away from zero, same double steps as the Spark helper."""
    s = f"{10 ** n}e0"
    return f"(sign({x}) * CAST(floor(abs({x}) * {s} + 0.5e0) AS BIGINT) / {s})"


def esum(x: str, n: int) -> str:
    s = f"{10 ** n}e0"
    return f"(CAST(SUM(CAST(round(({x}) * {s}) AS BIGINT)) AS DOUBLE) / {s})"


def eavg(x: str, n: int) -> str:
    return f"({esum(x, n)} / COUNT({x}))"


def to_int(x: str) -> str:
    return f"CAST(sign({x}) * CAST(floor(abs({x}) + 0.5e0) AS BIGINT) AS INTEGER)"


def least_strict(*xs: str) -> str:
    nulls = " OR ".join(f"({x}) IS NULL" for x in xs)
    return f"(CASE WHEN {nulls} THEN NULL ELSE least({', '.join(xs)}) END)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(v: float) -> str:
    return f"{float(v)!r}e0" if "e" not in repr(float(v)) else repr(float(v))


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%g')"


def skey(*parts: str) -> str:
    txt = ", ".join(f"coalesce({p}, {q(keys.NULL_PART)})" for p in parts)
    return f"md5(concat_ws({q(keys.SEPARATOR)}, {txt}))"


def date_lit(d) -> str:
    return f"DATE '{d.isoformat()}'"


# ----------------------------------------------------------------- CTE chain

def _spec_case(sensor: str, idx: int, type_col: str = "equipment_type") -> str:
    arms = " ".join(f"WHEN {q(t)} THEN {dbl(v[sensor][idx])}" for t, v in SPEC.items())
    return f"(CASE {type_col} {arms} END)"


def _unit_case(idx: int) -> str:
    arms = " ".join(f"WHEN {u[0]} THEN {q(u[idx]) if isinstance(u[idx], str) else dbl(u[idx])}"
                    for u in UNITS if u[idx] is not None)
    return f"(CASE no {arms} END)"


def _clamped(sensor: str, z: str) -> str:
    m, s, lo, hi = (_spec_case(sensor, i) for i in range(4))
    return hu(f"least(greatest({m} + {s} * ({z}), {lo}), {hi})", 2)


def base_ctes(p: Params = DEFAULT, scale_out: bool = False) -> dict[str, tuple[list[str], str]]:
    """name -> (dependencies, body)."""
    unit_id = ("equipment_type || '_' || CAST(user_id AS VARCHAR)" if scale_out else _unit_case(1))
    lim = p.limits
    thr = (f"(CASE WHEN health_score > 70 THEN {dbl(p.spike_sigma_healthy)} "
           f"WHEN health_score > 50 THEN {dbl(p.spike_sigma_degrading)} "
           f"ELSE {dbl(p.spike_sigma_critical)} END)")

    def spike(sensor: str, col: str) -> str:
        return (f"coalesce(abs({col} - {_spec_case(sensor, 0)}) / {_spec_case(sensor, 1)} > {thr}, false)")

    reason = ", ".join(f"CASE WHEN sp_{s} THEN {q(s + '_spike')} END" for s in SENSORS)
    oor = " OR ".join([
        f"coalesce(temperature < {dbl(lim.temp_min)} OR temperature > {dbl(lim.temp_max)}, false)",
        f"coalesce(vibration < {dbl(lim.vib_min)} OR vibration > {dbl(lim.vib_max)}, false)",
        f"coalesce(power_consumption < {dbl(lim.power_min)}, false)",
        f"coalesce(health_score < {dbl(lim.health_min)} OR health_score > {dbl(lim.health_max)}, false)",
    ])
    ctes = {
        "ev": ([], f"""
  SELECT event_id, ts, user_id, value, user_id % 5 AS no,
         date_diff('day', {date_lit(EPOCH)}, CAST(ts AS DATE)) AS dn
  FROM events"""),
        "ev2": (["ev"], f"SELECT *, {_unit_case(2)} AS equipment_type FROM ev"),
        "src": (["ev2"], f"""
  SELECT event_id,
    date_trunc('minute', ts) AS "timestamp",
    {unit_id} AS equipment_id,
    equipment_type,
    CASE WHEN event_id % 499 = 7 THEN 101e0
         WHEN no = 0 THEN least(100e0, 70e0 + 0.5e0 * dn)
         ELSE greatest(0e0, 100e0 - {_unit_case(3)} * dn - (event_id % 5) * 0.25e0) END AS health_score,
    CASE WHEN event_id % 997 = 3 THEN -60e0
         WHEN event_id % 101 = 5 THEN NULL
         ELSE {_clamped('temperature', '(value - 50e0) / 50e0')} END AS temperature,
    {_clamped('vibration', '(event_id * 7919 % 1000 - 500) / 250')} AS vibration,
    {_clamped('power_consumption', '(event_id * 104729 % 1000 - 500) / 250')} AS power_consumption,
    ts AS load_timestamp
  FROM ev2"""),
        "spk": (["src"], f"""
  SELECT *, {spike('temperature', 'temperature')} AS sp_temperature,
            {spike('vibration', 'vibration')} AS sp_vibration,
            {spike('power_consumption', 'power_consumption')} AS sp_power_consumption
  FROM src"""),
        "raw": (["spk"], f"""
  SELECT "timestamp", equipment_id, equipment_type, health_score, temperature, vibration,
         power_consumption,
         CAST(CASE WHEN sp_temperature OR sp_vibration OR sp_power_consumption THEN 1 ELSE 0 END AS INTEGER) AS is_anomaly,
         NULLIF(concat_ws(', ', {reason}), '') AS anomaly_reason,
         load_timestamp, event_id
  FROM spk"""),
        "flagged": (["raw"], f"SELECT *, ({oor}) AS is_out_of_range FROM raw"),
        "dedup": (["flagged"], """
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "timestamp", equipment_id
                                 ORDER BY load_timestamp DESC NULLS FIRST, event_id DESC) AS rn
    FROM flagged WHERE "timestamp" IS NOT NULL AND equipment_id IS NOT NULL) t
  WHERE rn = 1"""),
        "stg": (["dedup"], f"""
  SELECT {skey(ts_text('"timestamp"'), 'equipment_id')} AS sensor_id,
    "timestamp" AS event_timestamp,
    date_trunc('hour', "timestamp") AS event_hour,
    CAST("timestamp" AS DATE) AS event_date,
    load_timestamp AS loaded_at,
    equipment_id, equipment_type,
    {hu('temperature', 2)} AS temperature_celsius,
    {hu('vibration', 4)} AS vibration_mm_s,
    {hu('power_consumption', 2)} AS power_kw,
    {hu('health_score', 2)} AS health_score,
    is_anomaly, anomaly_reason, is_out_of_range
  FROM dedup"""),
        "valid": (["stg"], "SELECT * FROM stg WHERE NOT is_out_of_range"),
        "energy0": (["valid"], f"""
  SELECT event_hour, event_date, equipment_id, equipment_type,
    {hu(esum('power_kw', 2), 2)} AS total_power_kwh,
    {hu(eavg('power_kw', 2), 2)} AS avg_power_kw,
    {hu('max(power_kw)', 2)} AS peak_power_kw,
    {hu(eavg('temperature_celsius', 2), 2)} AS avg_temperature_c,
    {hu('max(temperature_celsius)', 2)} AS max_temperature_c,
    {hu(eavg('vibration_mm_s', 4), 4)} AS avg_vibration,
    {hu('max(vibration_mm_s)', 4)} AS max_vibration,
    {hu(eavg('health_score', 2), 2)} AS avg_health_score,
    {hu('min(health_score)', 2)} AS min_health_score,
    CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
    count(*) AS reading_count
  FROM valid GROUP BY event_hour, event_date, equipment_id, equipment_type"""),
        "energy": (["energy0"], f"SELECT {skey(ts_text('event_hour'), 'equipment_id')} AS fact_id, * FROM energy0"),
        "daily": (["valid"], f"""
  SELECT event_date, equipment_id, equipment_type,
    {hu(eavg('health_score', 2), 2)} AS avg_health_score,
    {hu('min(health_score)', 2)} AS min_health_score,
    CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
    count(*) AS reading_count,
    {hu('max(temperature_celsius)', 2)} AS max_temperature_c,
    {hu('max(vibration_mm_s)', 4)} AS max_vibration,
    {hu('max(power_kw)', 2)} AS max_power_kw,
    {hu(eavg('power_kw', 2), 4)} AS avg_power_kw,
    {hu(eavg('temperature_celsius', 2), 2)} AS avg_temperature_c,
    {hu(eavg('vibration_mm_s', 4), 4)} AS avg_vibration
  FROM valid GROUP BY event_date, equipment_id, equipment_type"""),
    }
    risk_arms = " ".join(
        f"WHEN min_health_score < {dbl(h)} OR anomaly_rate_pct > {dbl(r)} THEN {{{i}}}"
        for i, (_, _, h, r) in enumerate(rules.RISK_LEVELS))
    level = "CASE " + risk_arms.format(*[q(r[0]) for r in rules.RISK_LEVELS]) + f" ELSE {q(rules.RISK_DEFAULT[0])} END"
    action = "CASE " + risk_arms.format(*[q(r[1]) for r in rules.RISK_LEVELS]) + f" ELSE {q(rules.RISK_DEFAULT[1])} END"
    ctes["alert0"] = (["daily"], f"""
  SELECT event_date, equipment_id, equipment_type, avg_health_score, min_health_score,
    anomaly_count AS total_anomalies, reading_count AS total_readings,
    {hu('anomaly_count * 100e0 / NULLIF(reading_count, 0)', 2)} AS anomaly_rate_pct,
    max_temperature_c, max_vibration, max_power_kw
  FROM daily""")
    ctes["alert"] = (["alert0"], f"""
  SELECT {skey('CAST(event_date AS VARCHAR)', 'equipment_id')} AS alert_id, *,
    {level} AS risk_level, {action} AS recommended_action
  FROM alert0""")
    return ctes


def oee_ctes(p: Params, name: str = "oee") -> dict[str, tuple[list[str], str]]:
    ratio = "d.avg_power_kw / b.benchmark_power_kw"
    prod = "a_ * p_ * q_ * 100e0"
    classes = " ".join(f"WHEN {prod} >= {dbl(lim)} THEN {q(n)}" for n, lim in rules.OEE_CLASSES)
    low = least_strict("a_", "p_", "q_")
    usual = "x.expected_readings" if p.expected_per_day is None else str(int(p.expected_per_day))
    return {
        "cadence": (["daily"], """
  SELECT equipment_id, CAST(quantile_disc(reading_count, 0.5) AS BIGINT) AS expected_readings FROM daily GROUP BY equipment_id"""),
        "bench": (["daily"], "SELECT equipment_type, max(avg_power_kw) AS benchmark_power_kw FROM daily GROUP BY equipment_type"),
        f"{name}_c": (["daily", "bench", "cadence"], f"""
  SELECT d.*, b.benchmark_power_kw,
    {hu(f'least(d.reading_count / {usual}, 1e0)', 4)} AS a_,
    {hu(f'CASE WHEN b.benchmark_power_kw = 0 THEN 0e0 ELSE {least_strict(ratio, "1e0")} END', 4)} AS p_,
    {hu('1e0 - d.anomaly_count / NULLIF(d.reading_count, 0)', 4)} AS q_
  FROM daily d LEFT JOIN bench b ON d.equipment_type = b.equipment_type
  LEFT JOIN cadence x ON d.equipment_id IS NOT DISTINCT FROM x.equipment_id"""),
        name: ([f"{name}_c"], f"""
  SELECT {skey('CAST(event_date AS VARCHAR)', 'equipment_id')} AS oee_id,
    event_date, equipment_id, equipment_type,
    {hu('a_ * 100e0', 2)} AS availability_pct,
    {hu('p_ * 100e0', 2)} AS performance_pct,
    {hu('q_ * 100e0', 2)} AS quality_pct,
    {hu(prod, 2)} AS oee_score,
    CASE {classes} ELSE {q(rules.OEE_DEFAULT)} END AS oee_class,
    CASE WHEN {low} = a_ THEN 'Availability' WHEN {low} = p_ THEN 'Performance' ELSE 'Quality' END AS weakest_component,
    reading_count AS actual_readings, anomaly_count, avg_power_kw, benchmark_power_kw,
    avg_health_score, min_health_score, avg_temperature_c, avg_vibration
  FROM {name}_c"""),
    }


def forecast_ctes(p: Params, name: str = "forecast") -> dict[str, tuple[list[str], str]]:
    span = dbl(p.lag_span)
    crit = dbl(p.critical_health)
    now, back = "daily_avg_health", "health_7d_ago"
    days_arms = " ".join(f"WHEN days_to_failure <= {dbl(lim)} THEN {{{i}}}"
                         for i, (_, _, lim) in enumerate(rules.URGENCY_BY_DAYS))
    head = (f"WHEN current_health_score <= {crit} THEN {{n}} "
            f"WHEN days_to_failure IS NULL OR days_to_failure < 0 THEN {{s}} ")
    level = ("CASE " + head.format(n=q(rules.URGENCY_NOW[0]), s=q(rules.URGENCY_STABLE[0]))
             + days_arms.format(*[q(u[0]) for u in rules.URGENCY_BY_DAYS])
             + f" ELSE {q(rules.URGENCY_DEFAULT[0])} END")
    action = ("CASE " + head.format(n=q(rules.URGENCY_NOW[1]), s=q(rules.URGENCY_STABLE[1]))
              + days_arms.format(*[q(u[1]) for u in rules.URGENCY_BY_DAYS])
              + f" ELSE {q(rules.URGENCY_DEFAULT[1])} END")
    return {
        f"{name}_dh": (["daily"], f"""
  SELECT event_date, equipment_id, equipment_type, avg_health_score AS daily_avg_health,
    min_health_score AS daily_min_health, reading_count, anomaly_count
  FROM daily WHERE event_date <= {date_lit(p.as_of)}"""),
        f"{name}_lag": ([f"{name}_dh"], f"""
  SELECT *,
    lag(daily_avg_health, {int(p.lag_span)}) OVER w AS health_7d_ago,
    lag(daily_avg_health, 1) OVER w AS health_yesterday,
    row_number() OVER (PARTITION BY equipment_id ORDER BY event_date DESC, equipment_type DESC NULLS LAST) AS rn
  FROM {name}_dh
  WINDOW w AS (PARTITION BY equipment_id ORDER BY event_date, equipment_type NULLS FIRST)"""),
        f"{name}_c": ([f"{name}_lag"], f"""
  SELECT event_date AS forecast_as_of_date, equipment_id, equipment_type,
    {now} AS current_health_score, daily_min_health AS current_min_health, {back},
    {hu(f'{now} - {back}', 2)} AS health_change_7d,
    {hu(f'CASE WHEN {back} IS NULL THEN 0e0 ELSE ({back} - {now}) / {span} END', 4)} AS avg_daily_decline,
    {hu(f'''CASE WHEN {back} IS NULL OR ({back} - {now}) <= 0 THEN NULL
            WHEN {now} <= {crit} THEN 0e0
            ELSE ({now} - {crit}) / NULLIF(({back} - {now}) / {span}, 0) END''', 1)} AS days_to_failure,
    reading_count, anomaly_count
  FROM {name}_lag WHERE rn = 1"""),
        name: ([f"{name}_c"], f"""
  SELECT {skey('CAST(forecast_as_of_date AS VARCHAR)', 'equipment_id')} AS forecast_id,
    forecast_as_of_date, equipment_id, equipment_type, current_health_score, current_min_health,
    health_7d_ago, health_change_7d, avg_daily_decline, days_to_failure,
    CASE WHEN days_to_failure IS NOT NULL AND days_to_failure >= 0
         THEN CAST(forecast_as_of_date + {to_int('days_to_failure')} AS DATE) END AS predicted_failure_date,
    {level} AS urgency_level, {action} AS recommended_action,
    reading_count, anomaly_count
  FROM {name}_c"""),
    }


class Oracle:
    """Builds ``WITH ... SELECT`` text with just the CTEs a query needs."""

    def __init__(self, p: Params = DEFAULT, scale_out: bool = False):
        self.p = p
        self.ctes = base_ctes(p, scale_out)
        self.ctes.update(oee_ctes(p))
        self.ctes.update(forecast_ctes(p))

    def add(self, ctes: dict) -> "Oracle":
        self.ctes.update(ctes)
        return self

    def sql(self, body: str, *needs: str, extra: dict | None = None) -> str:
        ctes = dict(self.ctes)
        ctes.update(extra or {})
        order: list[str] = []

        def visit(n: str) -> None:
            if n in order:
                return
            for d in ctes[n][0]:
                visit(d)
            order.append(n)

        for n in needs:
            visit(n)
        if not order:
            return body
        chain = ",\n".join(f"{n} AS ({ctes[n][1]}\n)" for n in order)
        return f"WITH {chain}\n{body}"
