"""Ingestion: files into the raw table, the raw table into the landing zone, messages into staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import new_keys, new_rows
from ..sources import decode_events, extract_range, read_raw_trips, write_daily
from ..sources.files import ARRIVAL, list_files, read_raw_files
from ..sources.schemas import RAW_TRIP, columns
from ..sources.versions import PART, VERSION, Commit, commit, last_commit, read_parts, write_parts
from ..streaming import write_split_stream
from . import checks


def load_raw(
    spark: SparkSession, path: str, table: str, pattern: str = "*.csv", location: str | None = None
) -> None:
    """Append the rides of a CSV drop that the raw table does not hold yet.

    Only new rows are written; loading the same drop again adds nothing. A table that is not there yet is made,
    at ``location`` if it is given. A table that is there is first asked by ids alone: where it holds all of them, no
    other column of the drop is read or shuffled.
    """
    is_new = not spark.catalog.tableExists(table)
    if is_new:
        empty = spark.createDataFrame([], RAW_TRIP).write.format("parquet")
        (empty.option("path", location) if location else empty).saveAsTable(table)
    incoming = read_raw_trips(spark, path, pattern, with_arrival=True)
    if not is_new and new_keys(spark.table(table), incoming, "ride_id").isEmpty():
        return
    new_rows(spark.table(table), incoming, "ride_id", ARRIVAL).write.mode("append").saveAsTable(table)


RIDES, LEDGER = "rides", "ledger"
_LEDGER = columns(
    "path string, length long, modified timestamp, rows long, first_ride string, last_ride string, load long"
)


def load_raw_ledger(spark: SparkSession, drop: str, path: str, pattern: str = "*.csv") -> list[str]:
    """Append the rides of the files that no load has read yet to the raw table at ``path``; the files that were read.

    The ledger holds path, length, time, number of rows and range of ids of each file that was loaded. A file that
    is in it as it lies there is skipped unread: repeating a load lists the drop and reads nothing. A file that was
    changed or replaced is read again, and rides that are stored already stay as they were first loaded. Stored ids are
    compared only with loads whose range of ids meets that of the new files. Rides and ledger are one commit.
    """
    old = last_commit(spark, path)
    number = old.number + 1
    ledger = read_parts(spark, path, LEDGER, _LEDGER, old)
    loaded = ledger.select("path", "length", "modified")
    # The new files: what the planner needs on the driver in any case to read them.
    files = list_files(spark, drop, pattern).join(loaded, ["path", "length", "modified"], "left_anti").collect()
    names = sorted(r.path for r in files)
    if not names:
        return []
    incoming = read_raw_files(spark, names, with_arrival=True).persist()
    try:
        parts = dict(old.parts)
        _write_load(spark, path, number, old, incoming, files, ledger, parts)
    finally:
        # A file may be replaced under its name: what was read of it must not outlive the load.
        incoming.unpersist(blocking=True)
    commit(spark, path, Commit(number, parts))
    return names


def _write_load(
    spark: SparkSession,
    path: str,
    number: int,
    old: Commit,
    incoming: DataFrame,
    files: list[Row],
    ledger: DataFrame,
    parts: dict,
) -> None:
    """Write new rides and the ledger of a load, and enter them in ``parts``."""
    ranges = incoming.groupBy(F.col(ARRIVAL[0]).alias("path")).agg(
        F.count("*").alias("rows"), F.min("ride_id").alias("first_ride"), F.max("ride_id").alias("last_ride")
    )
    first, last = incoming.agg(F.min("ride_id"), F.max("ride_id")).first()
    meets = ledger.where((F.col("first_ride") <= F.lit(last)) & (F.col("last_ride") >= F.lit(first)))
    loads = [r[0] for r in meets.select("load").distinct().collect()]
    stored = read_parts(spark, path, RIDES, RAW_TRIP, old, [_load_part(n) for n in loads]).drop(PART, VERSION)
    new = new_rows(stored, incoming, "ride_id", ARRIVAL).withColumn(PART, F.lit(_load_part(number)))
    for p in write_parts(new, path, RIDES, number, ["ride_id"], gather=False):
        parts[RIDES, p] = (number,)
    listed = spark.createDataFrame(files, columns("path string, length long, modified timestamp"))
    listed = listed.join(ranges, "path", "left").select(
        "path", "length", "modified", F.coalesce("rows", F.lit(0)).alias("rows"), "first_ride", "last_ride"
    )
    listed = listed.withColumns({"load": F.lit(number).cast("long"), PART: F.lit(_load_part(number))})
    for p in write_parts(listed, path, LEDGER, number):
        parts[LEDGER, p] = (number,)


def _load_part(number: int) -> str:
    return f"load-{number:06d}"


def read_raw_loads(spark: SparkSession, path: str) -> DataFrame:
    """The raw table of :func:`load_raw_ledger`."""
    return read_parts(spark, path, RIDES, RAW_TRIP, last_commit(spark, path)).drop(PART, VERSION)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The files that were loaded."""
    return read_parts(spark, path, LEDGER, _LEDGER, last_commit(spark, path)).drop(PART, VERSION)


def land_trips(raw: DataFrame, path: str, start: str, end: str) -> None:
    """Write the rides that started in ``[start, end)`` to the landing zone, one folder per day.

    Fails if there is none: an empty source means that something upstream went wrong.
    """
    rides = extract_range(raw, start, end)
    checks.require(checks.expect_rows(rides.select(F.lit(1)), "raw trips"))
    write_daily(rides, path)


def ingest_messages(
    messages: DataFrame,
    valid_path: str,
    invalid_path: str,
    checkpoint: str,
    column: str = "value",
    fmt: str = "json",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Decode a stream of messages, validate it, and append valid and quarantined events to two sinks."""
    events = decode_events(messages.select(column), column, fmt, keep_payload=True)
    return write_split_stream(events, valid_path, invalid_path, checkpoint, trigger)
