"""The same column helpers as SQL expression text, for ``selectExpr``.

Building a wide projection from Column objects costs one JVM round trip
per function call; a SQL expression string is parsed in one. The text
builds exactly the expression tree of the Column helpers (double
literals carry the ``D`` suffix; a bare ``1.0`` would be a decimal).
"""

from __future__ import annotations


def dbl(v: float) -> str:
    return f"{float(v)!r}D"


def half_up(x: str, digits: int) -> str:
    s = dbl(10 ** digits)
    return f"((CAST(signum({x}) AS INT) * FLOOR(ABS({x}) * {s} + 0.5D)) / {s})"


def quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def case(col: str, arms, default: str | None = None) -> str:
    """CASE WHEN col = key THEN value ... [ELSE default] END (keys/values already SQL text)."""
    body = " ".join(f"WHEN {col} = {k} THEN {v}" for k, v in arms)
    tail = f" ELSE {default}" if default is not None else ""
    return f"CASE {body}{tail} END"


def exact_sum(x: str, digits: int) -> str:
    """Aggregate: exact sum of values with ``digits`` decimals (scaled longs)."""
    s = dbl(10 ** digits)
    return f"(CAST(SUM(CAST(rint({x} * {s}) AS BIGINT)) AS DOUBLE) / {s})"


def exact_avg(x: str, digits: int) -> str:
    return f"({exact_sum(x, digits)} / COUNT({x}))"
