"""Generic DataFrame operators. Column names and thresholds are parameters."""

from .aggregates import (
    count_distinct_multi,
    count_where,
    distinct_sketch,
    merge_sketches,
    peak_bucket,
    share_of_total,
    sketch_error,
    top_k,
)
from .history import drop_anomaly, with_previous
from .joins import append_new, full_outer_on, in_force, left_lookup, new_keys, new_rows
from .pick import dedupe_first, latest_per_key, total_order
from .sides import stack_sides

__all__ = [
    "append_new",
    "count_distinct_multi",
    "count_where",
    "dedupe_first",
    "distinct_sketch",
    "drop_anomaly",
    "full_outer_on",
    "in_force",
    "latest_per_key",
    "left_lookup",
    "merge_sketches",
    "new_keys",
    "new_rows",
    "peak_bucket",
    "share_of_total",
    "sketch_error",
    "stack_sides",
    "top_k",
    "total_order",
    "with_previous",
]
