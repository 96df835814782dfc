"""Column helpers that keep results identical across engines.

* ``half_up``: round half away from zero, computed on the binary double,
  with an integer intermediate so a negative value that rounds to zero
  gives 0.0 (not -0.0).
* ``exact_sum`` / ``exact_avg``: staged readings carry a fixed number of
  decimals, so summing them as scaled longs is exact and order-free, and
  stays inside whole-stage codegen (no decimal buffers).
* ``least_strict``: LEAST that returns NULL when any argument is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(c, digits: int) -> Column:
    c = _c(c)
    scale = float(10**digits)
    return (F.signum(c).cast("int") * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5))) / F.lit(scale)


def scaled_long(c, digits: int) -> Column:
    """A value already at ``digits`` decimals as an exact long count of units."""
    return F.rint(_c(c) * F.lit(float(10**digits))).cast("long")


def exact_sum(c, digits: int) -> Column:
    """Aggregate: exact sum of values that have ``digits`` decimals."""
    return F.sum(scaled_long(c, digits)).cast("double") / F.lit(float(10**digits))


def exact_avg(c, digits: int) -> Column:
    """Aggregate: exact sum divided by the count of non-NULL values."""
    return exact_sum(c, digits) / F.count(_c(c))


def nullif(c, value) -> Column:
    c = _c(c)
    return F.when(c == F.lit(value), F.lit(None)).otherwise(c)


def least_strict(*cols) -> Column:
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def round_to_int(c) -> Column:
    """Numeric -> int rounding half away from zero (a warehouse cast)."""
    c = _c(c)
    return (F.signum(c).cast("int") * F.floor(F.abs(c) + F.lit(0.5))).cast("int")
