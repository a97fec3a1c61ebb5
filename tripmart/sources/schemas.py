"""Declared schemas. Nothing is inferred: station ids such as ``5303.10`` must stay text."""

from __future__ import annotations

import json

from pyspark.sql import types as T

_S, _D, _I, _B, _TS = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def columns(text: str) -> T.StructType:
    """The schema of ``name type, name type, ...`` (integer, long, string, date, timestamp); needs no session."""
    out = T.StructType()
    for field in text.split(","):
        name, kind = field.split()
        out = out.add(name, kind)
    return out


# Column names and types of the trip and station records.
RAW_TRIP = _struct(
    ("ride_id", _S),
    ("rideable_type", _S),
    ("started_at", _TS),
    ("ended_at", _TS),
    ("start_station_name", _S),
    ("start_station_id", _S),
    ("end_station_name", _S),
    ("end_station_id", _S),
    ("start_lat", _D),
    ("start_lng", _D),
    ("end_lat", _D),
    ("end_lng", _D),
    ("member_casual", _S),
)
STAGING_TRIP = _struct(*[(f.name, _S) for f in RAW_TRIP], ("trip_date", _S))

STATION_EVENT = _struct(
    ("station_id", _S),
    ("station_name", _S),
    ("lat", _D),
    ("lon", _D),
    ("capacity", _I),
    ("num_bikes_available", _I),
    ("num_docks_available", _I),
    ("num_ebikes_available", _I),
    ("is_installed", _B),
    ("is_renting", _B),
    ("is_returning", _B),
    ("event_timestamp", _TS),
)
# The fields a publisher may leave out; all others are required.
OPTIONAL_FIELDS = ("station_name", "lat", "lon", "capacity", "num_ebikes_available")
REQUIRED_FIELDS = tuple(f.name for f in STATION_EVENT if f.name not in OPTIONAL_FIELDS)

INVALID_EVENT = _struct(
    ("station_id", _S), ("error_reason", _S), ("raw_payload", _S), ("event_timestamp", _TS)
)

# Feed records. Ids, counts and flags are read as text because publishers mix numbers, booleans and text.
STATION_INFO = _struct(
    ("station_id", _S), ("name", _S), ("lat", _D), ("lon", _D), ("capacity", _I)
)
STATION_STATUS = _struct(
    ("station_id", _S),
    ("num_bikes_available", _S),
    ("num_docks_available", _S),
    ("num_ebikes_available", _S),
    ("is_installed", _S),
    ("is_renting", _S),
    ("is_returning", _S),
)

_AVRO_TYPES = {
    "string": "string",
    "double": "double",
    "int": "int",
    "boolean": "boolean",
    "timestamp_ntz": {"type": "long", "logicalType": "timestamp-millis"},
}


def _avro_field(field: T.StructField) -> dict:
    kind = _AVRO_TYPES[field.dataType.simpleString()]
    if field.name in OPTIONAL_FIELDS:
        return {"name": field.name, "type": ["null", kind], "default": None}
    return {"name": field.name, "type": kind}


# The wire format of a station event as an Avro record (used only with the spark-avro package).
STATION_EVENT_AVRO = json.dumps(
    {"type": "record", "name": "StationEvent", "fields": [_avro_field(f) for f in STATION_EVENT]}
)
