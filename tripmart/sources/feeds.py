"""Station feeds: JSON snapshots that wrap their records in ``data.stations``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Time of a poll from the path of its snapshot file.
TakenAt = Callable[[Column], Column]


def time_in_path(pattern: str, fmt: str) -> TakenAt:
    """The time that group 1 of ``pattern`` finds in a path, written as ``fmt``; NULL where there is none."""
    return lambda path: F.try_to_timestamp(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), F.lit(fmt))


def _snapshot(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(record))]))])


def _records(snapshots: DataFrame, taken_at: TakenAt | None) -> DataFrame:
    stored = F.col("_metadata.file_modification_time")
    time = stored if taken_at is None else F.coalesce(taken_at(F.col("_metadata.file_path")), stored)
    exploded = snapshots.select(
        F.col("_metadata.file_path").alias("poll"),
        F.date_trunc("millisecond", time).cast("timestamp_ntz").alias("polled_at"),
        F.posexplode("data.stations").alias("pos", "s"),
    )
    return exploded.select("poll", "polled_at", (F.col("pos") + 1).alias("position"), "s.*")


def read_station_feed(
    spark: SparkSession, path: str, record: T.StructType, taken_at: TakenAt | None = None
) -> DataFrame:
    """One row per station record, with ``poll`` (the snapshot file), ``polled_at`` and ``position`` (1-based).

    ``polled_at`` is when the snapshot was stored, or what ``taken_at`` finds in its path, so polls that are read
    together keep times of their own.

    Each snapshot is one file and one task; a snapshot lists each station of a system once.
    """
    return _records(spark.read.schema(_snapshot(record)).option("multiLine", True).json(path), taken_at)


def read_station_feed_stream(
    spark: SparkSession,
    path: str,
    record: T.StructType,
    taken_at: TakenAt | None = None,
    polls_per_batch: int | None = None,
) -> DataFrame:
    """The same over snapshots that keep landing in a folder, in the order in which they were stored.

    The times are those of the files, not of the micro-batch, so a stream that catches up after a pause, or reads
    several polls at once, gives the events that it would have given without.
    """
    reader = spark.readStream.schema(_snapshot(record)).option("multiLine", True)
    if polls_per_batch:
        reader = reader.option("maxFilesPerTrigger", polls_per_batch)
    return _records(reader.json(path), taken_at)
