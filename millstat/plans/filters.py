"""Page filters: the choices a report reader makes, as one predicate on a mart.

A filtered mart is a mart, so every report takes one. All conditions are plain
comparisons of columns with literals: they reach the scan as partition and pushed filters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE_COLUMNS = ("event_date", "forecast_as_of_date")


def page_filter(mart: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
                ranges: dict[str, tuple[float, float]] | None = None, **chosen: Iterable[str] | None) -> DataFrame:
    """Rows of ``mart`` between two dates (both included) whose columns have chosen values.

    ``chosen`` maps a column to its values, ``ranges`` to its bounds (both included). What is None is
    not filtered; an empty choice keeps no row; a NULL value is never in a choice or range.
    """
    if start is not None or end is not None:
        date = next(F.col(c) for c in DATE_COLUMNS if c in mart.columns)
        if start is not None:
            mart = mart.where(date >= F.lit(start))
        if end is not None:
            mart = mart.where(date <= F.lit(end))
    for column, (low, high) in (ranges or {}).items():
        mart = mart.where(F.col(column).between(low, high))
    for column, values in chosen.items():
        if values is not None:
            mart = mart.where(F.col(column).isin(list(values)))
    return mart
