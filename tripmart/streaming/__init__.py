"""Event building, validation, quarantine, and the streaming twins of the event marts."""

from .drops import detect_drops_stream, read_drops
from .feed import append_information, build_events, feed_events_stream, inject_faults
from .index import dedupe_stream_indexed, read_deduped_indexed
from .sinks import append_batches, write_split_stream
from .slices import read_repaired, repair_drops_stream
from .splitlog import read_split, write_split_log
from .state import dedupe_stream, latest_status_stream, read_deduped, read_latest
from .validate import split_valid_invalid, validate_events

__all__ = [
    "append_batches",
    "append_information",
    "build_events",
    "dedupe_stream",
    "dedupe_stream_indexed",
    "detect_drops_stream",
    "feed_events_stream",
    "inject_faults",
    "latest_status_stream",
    "read_deduped",
    "read_deduped_indexed",
    "read_drops",
    "read_latest",
    "read_repaired",
    "read_split",
    "repair_drops_stream",
    "split_valid_invalid",
    "validate_events",
    "write_split_log",
    "write_split_stream",
]
