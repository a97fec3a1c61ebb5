"""Schemas, readers and writers."""

from .feeds import read_station_feed, read_station_feed_stream, time_in_path
from .files import read_raw_trips, read_staging_trips, write_daily
from .messages import decode_events, read_event_stream
from .relational import day_predicates, extract_range, read_trips_jdbc, trip_dates
from .scratch import scratch_path
from .tables import ensure_layers, register_views, write_bucketed, write_fact, write_table

__all__ = [
    "day_predicates",
    "decode_events",
    "ensure_layers",
    "extract_range",
    "read_event_stream",
    "read_raw_trips",
    "read_staging_trips",
    "read_station_feed",
    "read_station_feed_stream",
    "read_trips_jdbc",
    "register_views",
    "scratch_path",
    "time_in_path",
    "trip_dates",
    "write_bucketed",
    "write_daily",
    "write_fact",
    "write_table",
]
