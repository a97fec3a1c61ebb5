"""Column expressions. Everything here stays inside Catalyst: no Python runs per row."""

from .casts import safe_date, safe_double, safe_long, safe_timestamp
from .geo import EARTH_RADIUS_KM, distance_km
from .rounding import hundredths, mean_2dp, ratio_2dp, round_2dp
from .temporal import day_name, elapsed_seconds, is_weekend, time_of_day
from .text import WHITESPACE, blank_to_null, fold, not_blank, trim_ws

__all__ = [
    "EARTH_RADIUS_KM",
    "WHITESPACE",
    "blank_to_null",
    "day_name",
    "distance_km",
    "elapsed_seconds",
    "fold",
    "hundredths",
    "is_weekend",
    "mean_2dp",
    "not_blank",
    "ratio_2dp",
    "round_2dp",
    "safe_date",
    "safe_double",
    "safe_long",
    "safe_timestamp",
    "time_of_day",
    "trim_ws",
]
