"""Stable text keys: md5 over the '-'-joined text of the key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's key macro for identical keys):
# text used in place of a NULL key part, and the key-part separator.
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"
# timestamps are rendered with millisecond precision
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"


def _as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, TS_TEXT)
    return c.cast("string")


def surrogate_key(df, *names: str) -> Column:
    """md5 key of ``names`` as they are typed in ``df`` (NULL-safe)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.coalesce(_as_text(F.col(n), types[n]), F.lit(NULL_PART)) for n in names]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
