"""Casts of text that yield NULL instead of failing.

Spark's own ``try_cast`` is more lenient than a warehouse's safe cast: it reads ``'2026'`` and even
``'10:00'`` as timestamps and ``'1.5d'`` as a number. Each cast is therefore guarded by the shape of
the text. The guards are single linear regular expressions and stay in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOCAL_TIMESTAMP = (
    r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?\s*$"
)
_STARTS_WITH_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}[ T]"
_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
_DOUBLE = r"(?i)^\s*[+-]?(\d+(\.\d*)?(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"
_LONG = r"^\s*[+-]?\d+\s*$"


def safe_timestamp(c: Column) -> Column:
    """Text to a zone-free UTC timestamp. Text that names a zone or offset is shifted to UTC."""
    zoned = F.convert_timezone(None, F.lit("UTC"), c.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(c.rlike(_LOCAL_TIMESTAMP), c.try_cast("timestamp_ntz")).when(
        c.rlike(_STARTS_WITH_DATE), zoned
    )


def safe_date(c: Column) -> Column:
    return F.when(c.rlike(_DATE), c.try_cast("date"))


def safe_double(c: Column) -> Column:
    return F.when(c.rlike(_DOUBLE), c.try_cast("double"))


def safe_long(c: Column) -> Column:
    return F.when(c.rlike(_LONG), c.try_cast("bigint"))
