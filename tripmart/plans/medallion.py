"""The whole batch run in order: staging, dimensions, cleaned facts, marts, checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources import ensure_layers, register_views, write_fact, write_table
from ..streaming.validate import split_valid_invalid
from . import checks, marts
from .events import clean_events
from .stations import batch_station_reference, station_mapping, stream_station_reference
from .trips import clean_trips


@dataclass(frozen=True)
class Silver:
    """The written tables that the marts read."""

    trips: DataFrame
    events: DataFrame
    mapping: DataFrame


def build_dimensions(
    staging_trips: DataFrame, staging_events: DataFrame, prefix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Station references of both sides, as replaced tables. Only valid events describe a station."""
    valid, _ = split_valid_invalid(staging_events)
    return (
        write_table(batch_station_reference(staging_trips), f"{prefix}staging.dim_batch_station_reference"),
        write_table(stream_station_reference(valid), f"{prefix}staging.dim_stream_station_reference"),
    )


def build_silver(
    staging_trips: DataFrame, staging_events: DataFrame, batch_ref: DataFrame, stream_ref: DataFrame, prefix: str = ""
) -> Silver:
    """The cleaned facts, laid out by day and clustered for the marts, and the station mapping.

    ``prefix`` is put before the names of the namespaces.

    Parquet cannot partition by an expression, so the event day becomes a column of the layout; reading
    back drops it again.
    """
    trips = write_fact(
        clean_trips(staging_trips),
        f"{prefix}silver.fact_trips_cleaned",
        "trip_date",
        ["member_casual", "start_station_id"],
    )
    cleaned = clean_events(staging_events)
    events = write_fact(
        cleaned.withColumn("event_date", cleaned.event_timestamp.cast("date")),
        f"{prefix}silver.fact_valid_events_cleaned",
        "event_date",
        ["station_id"],
    ).drop("event_date")
    mapping = write_table(station_mapping(batch_ref, stream_ref), f"{prefix}silver.dim_station_mapping")
    return Silver(trips, events, mapping)


def gold(silver: Silver) -> dict[str, DataFrame]:
    """The six marts as lazy DataFrames over the written facts."""
    return {
        "mart_daily_trip_summary": marts.daily_trip_summary(silver.trips),
        "mart_latest_station_status": marts.latest_station_status(silver.events),
        "mart_station_anomaly_monitoring": marts.station_anomaly(silver.events),
        "mart_station_summary": marts.station_summary(silver.trips, silver.mapping),
        "mart_station_user_summary": marts.station_user_summary(silver.trips),
        "mart_user_type_summary": marts.user_type_summary(silver.trips),
    }


def silver_checks(silver: Silver) -> DataFrame:
    return checks.union(
        checks.row_counts(
            {
                "fact_trips_cleaned": silver.trips,
                "fact_valid_events_cleaned": silver.events,
                "dim_station_mapping": silver.mapping,
            },
            minimum=1,
        ),
        checks.expect_unique(silver.trips, "fact_trips_cleaned", "ride_id"),
        checks.null_profile(silver.trips, "fact_trips_cleaned", checks.trip_rules()),
    )


def run_batch(
    spark: SparkSession, staging_trips: DataFrame, staging_events: DataFrame, gate: bool = True
) -> dict[str, DataFrame]:
    """Run every step in order and register the marts as views.

    ``gate`` stops the run at the first layer whose checks fail.
    """

    def check(results: DataFrame) -> None:
        if gate:
            checks.require(results)

    ensure_layers(spark)
    trips = write_table(staging_trips, "staging.fact_trips")
    check(checks.row_counts({"fact_trips": trips, "fact_station_events": staging_events}, minimum=1))
    batch_ref, stream_ref = build_dimensions(trips, staging_events)
    silver = build_silver(trips, staging_events, batch_ref, stream_ref)
    check(silver_checks(silver))
    views = gold(silver)
    register_views(views)
    check(checks.row_counts(views, minimum=1))
    return views
