"""Cleaned station events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import not_blank, trim_ws
from ..operators import dedupe_first, total_order


def valid_events(events: DataFrame) -> DataFrame:
    """Events with a non-blank station, a position on the globe, no negative counts and a timestamp."""
    return events.filter(
        not_blank(F.col("station_id"))
        & not_blank(F.col("station_name"))
        & F.col("lat").between(-90, 90)
        & F.col("lon").between(-180, 180)
        & (F.col("capacity") >= 0)
        & (F.col("num_bikes_available") >= 0)
        & (F.col("num_docks_available") >= 0)
        & F.col("event_timestamp").isNotNull()
    )


def clean_events(events: DataFrame) -> DataFrame:
    """The event fact: valid events with trimmed labels, one per station and timestamp.

    Replays of a message are equal in every column, so which copy survives does not matter; if copies
    differ, the first by content is kept.
    """
    keys = ["station_id", "event_timestamp"]
    trimmed = valid_events(events).withColumns(
        {c: trim_ws(F.col(c)) for c in ("station_id", "station_name")}
    )
    return dedupe_first(trimmed, keys, total_order(trimmed, [], skip=keys))
