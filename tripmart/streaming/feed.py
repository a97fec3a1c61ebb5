"""Events from the status and the information feed, and injected faults for trials."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import in_force, left_lookup
from ..sources.schemas import STATION_INFO
from .sinks import start_query

_COUNTS = ("num_bikes_available", "num_docks_available", "num_ebikes_available")
_FLAGS = ("is_installed", "is_renting", "is_returning")
_FALSY = ("", "0", "0.0", "false")

# The fields a fault may hit and what it writes there.
FAULTS = (("station_id", ""), ("num_bikes_available", -1), ("num_docks_available", -1))


def _count(c: Column) -> Column:
    """Missing counts are 0; a fraction is cut."""
    return F.coalesce(c.cast("double").cast("int"), F.lit(0))


def _flag(c: Column) -> Column:
    """Publishers send flags as booleans or as 0/1; a missing flag is false."""
    return F.coalesce(~F.lower(c.cast("string")).isin(*_FALSY), F.lit(False))


def build_events(
    status: DataFrame,
    info: DataFrame,
    now: Column | None = None,
    last_by: Sequence[Column] | None = None,
    keep: Sequence[str] = (),
    version: str | None = None,
) -> DataFrame:
    """Station events: status records with the attributes of their station, NULL if it is unknown.

    ``info`` is the static side, read once; ``last_by`` says which of several records of a station
    counts. ``version`` names a column of both sides in which they must agree as well: the version of the
    information that was in force. ``status`` may be a stream. ``now`` is the event time, by default the column ``polled_at`` that
    :func:`tripmart.sources.read_station_feed` adds. There is no clock to fall back on: polls that are read
    together would share its time, and cleaning would take all but one of them for copies.
    """
    if now is None:
        if "polled_at" not in status.columns:
            raise ValueError("status has no column polled_at; name the event time with now=")
        now = F.col("polled_at")
    known = info.withColumn("station_id", F.col("station_id").cast("string"))
    typed = status.withColumn("station_id", F.col("station_id").cast("string"))
    attributes = {"station_name": "name", "lat": "lat", "lon": "lon", "capacity": "capacity"}
    match = ["station_id", *([version] if version else [])]
    joined = left_lookup(typed, known, match, match, attributes, last_by)
    return joined.select(
        *keep,
        "station_id",
        *attributes,
        *[_count(F.col(c)).alias(c) for c in _COUNTS],
        *[_flag(F.col(c)).alias(c) for c in _FLAGS],
        now.alias("event_timestamp"),
    )


#: Information records of all versions: each is in force from ``valid_from`` until the next one is.
STATION_INFO_VERSION = T.StructType([*STATION_INFO.fields, T.StructField("valid_from", T.TimestampNTZType())])


def append_information(info: DataFrame, path: str, valid_from: datetime) -> None:
    """Add a version of the station information, which polls from ``valid_from`` on are matched with.

    A version is whole: a station that it does not list is unknown while it is in force.
    """
    time = F.lit(valid_from.isoformat(" ")).cast("timestamp_ntz")
    rows = info.select(*[F.col(f.name).cast(f.dataType) for f in STATION_INFO], time.alias("valid_from"))
    rows.coalesce(1).write.mode("append").parquet(path)


def feed_events_stream(
    status: DataFrame,
    information: str,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    last_by: Sequence[Column] | None = None,
    invalid_every: int | None = None,
    anomaly_every: int | None = None,
    seed: int = 0,
    choice: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Turn polls that keep arriving into station events, and give those of each micro-batch to ``sink``.

    ``status`` is the stream of :func:`tripmart.sources.read_station_feed_stream`. ``information`` is the path of a
    table of versions (:func:`append_information`). It is read anew by every micro-batch, so a version that is added
    while the stream runs counts from the next one on, and each poll is matched with the version in force at its own
    time, also when polls of several days are read together. Faults are injected by position within each poll.

    A batch that runs again gives the same events: all it depends on is stored, but for versions added meanwhile.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        info = batch.sparkSession.read.schema(STATION_INFO_VERSION).parquet(information)
        polls = batch.select("poll", "polled_at").distinct()
        known = in_force(polls, info, "polled_at", "valid_from").select("poll", "valid_from")
        events = build_events(
            batch.join(known, "poll", "left"), info, last_by=last_by, keep=["poll", "position"], version="valid_from"
        )
        spoiled = inject_faults(events, F.col("position"), invalid_every, anomaly_every, seed, choice)
        sink(spoiled.drop("poll", "position"), batch_id)

    return start_query(status, checkpoint, process, trigger or {"availableNow": True}, "append")


def inject_faults(
    events: DataFrame,
    position: Column,
    invalid_every: int | None = None,
    anomaly_every: int | None = None,
    seed: int = 0,
    choice: Column | None = None,
) -> DataFrame:
    """Spoil every ``invalid_every``-th record of a poll and empty every ``anomaly_every``-th station.

    ``position`` counts the records of a poll from 1. An invalid record gets one of :data:`FAULTS`, by
    default a repeatable pseudo-random one; ``choice`` (0, 1 or 2) overrides it. Invalid wins over
    anomaly.
    """
    if choice is None:
        choice = F.pmod(F.xxhash64(F.lit(seed), position, F.col("station_id")), F.lit(len(FAULTS)))

    def every(n: int | None) -> Column:
        return (position % n == 0) if n else F.lit(False)

    invalid = every(invalid_every)
    spoiled = {
        field: F.when(invalid & (choice == i), F.lit(value)) for i, (field, value) in enumerate(FAULTS)
    }
    spoiled["num_bikes_available"] = spoiled["num_bikes_available"].when(
        ~invalid & every(anomaly_every), F.lit(0)
    )
    return events.withColumns({c: fault.otherwise(F.col(c)) for c, fault in spoiled.items()})
