"""Time expressions. They work on zone-free timestamps, so no session time zone leaks in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names from Sunday (1) to Saturday (7).
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# First and last hour of each named part of the day; every other hour is night.
DAY_PARTS = (("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 20))
OTHER_DAY_PART = "Night"


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``; fractions are cut, not rounded."""
    return F.timestamp_diff("SECOND", start, end)


def day_name(ts: Column) -> Column:
    return F.elt(F.dayofweek(ts), *[F.lit(d) for d in DAY_NAMES])


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def time_of_day(hour: Column) -> Column:
    """Named part of the day; a NULL hour falls into the last class."""
    first, *rest = DAY_PARTS
    out = F.when(hour.between(first[1], first[2]), first[0])
    for name, lo, hi in rest:
        out = out.when(hour.between(lo, hi), name)
    return out.otherwise(OTHER_DAY_PART)
