"""Rule validation with accumulated reasons. Works on batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import INVALID_EVENT, REQUIRED_FIELDS, STATION_EVENT

# A blank (but not empty) id passes here; it is dropped when events are cleaned.
_REASON = "error_reason"


def validate_events(events: DataFrame) -> DataFrame:
    """Add ``error_reason``: the broken rules in order, joined by a comma; NULL if there is none.

    After the three rules on values come the required fields that are NULL. A payload that could not be decoded
    (see :func:`tripmart.sources.decode_events`) is reported as such alone.
    """
    station = F.col("station_id")
    # The rules and the texts that report them, in order.
    rules = (
        (station.isNull() | (station == ""), "station_id is empty"),
        (F.col("num_bikes_available") < 0, "num_bikes_available is negative"),
        (F.col("num_docks_available") < 0, "num_docks_available is negative"),
    )
    missing = [(F.col(c).isNull(), f"{c} is missing") for c in REQUIRED_FIELDS if c != "station_id"]
    reasons = F.concat_ws(", ", *[F.when(broken, text) for broken, text in (*rules, *missing)])
    if "undecodable" in events.columns:
        reasons = F.when(F.col("undecodable"), "payload is undecodable").otherwise(reasons)
    return events.withColumn(_REASON, F.nullif(reasons, F.lit("")))


def split_valid_invalid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid events, quarantine). A quarantined row keeps its whole payload: the message, or the event as JSON."""
    return split_validated(validate_events(events))


def split_validated(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = [f.name for f in STATION_EVENT]
    valid = checked.filter(F.col(_REASON).isNull()).select(*names)
    payload = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    if "raw_payload" in checked.columns:
        payload = F.coalesce("raw_payload", payload)
    rows = checked.filter(F.col(_REASON).isNotNull()).withColumn("raw_payload", payload)
    return valid, rows.select(*[F.col(f.name).cast(f.dataType) for f in INVALID_EVENT])
