"""Domain rules on hand-written rows, and properties of the marts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.plans import checks, marts, medallion, stations
from tripmart.plans.events import clean_events
from tripmart.plans.trips import clean_trips
from tripmart.showcase.inputs import staging_trips, station_events
from tripmart.sources.schemas import STAGING_TRIP, STATION_EVENT

SF_DIR = "/root/testdata/sf0.001"
TRIP = {
    "ride_id": "r1", "rideable_type": "classic_bike", "started_at": "2024-01-05 08:00:00",
    "ended_at": "2024-01-05 08:30:00", "start_station_name": "A", "start_station_id": "1",
    "end_station_name": "B", "end_station_id": "2", "start_lat": "40.7", "start_lng": "-74.0",
    "end_lat": "40.8", "end_lng": "-74.0", "member_casual": "member", "trip_date": "2024-01-05",
}
EVENT = {
    "station_id": "s", "station_name": "S", "lat": 1.0, "lon": 1.0, "capacity": 10, "num_bikes_available": 1,
    "num_docks_available": 9, "num_ebikes_available": 0, "is_installed": True, "is_renting": True,
    "is_returning": True, "event_timestamp": dt.datetime(2024, 1, 1),
}


def staging(spark, *changes):
    rows = [tuple({**TRIP, **c}[f.name] for f in STAGING_TRIP) for c in changes]
    return spark.createDataFrame(rows, STAGING_TRIP)


def station_rows(spark, *changes):
    rows = [tuple({**EVENT, **c}[f.name] for f in STATION_EVENT) for c in changes]
    return spark.createDataFrame(rows, STATION_EVENT)


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"ended_at": "2024-01-06 08:00:00"}, True),  # exactly 1440 minutes
        ({"ended_at": "2024-01-06 08:00:00.9"}, True),  # still 1440 whole minutes
        ({"ended_at": "2024-01-06 08:00:01"}, False),
        ({"ended_at": "2024-01-05 08:00:00"}, False),
        ({"ended_at": "2024-01-05 08:00:00.9"}, False),  # 0.00 minutes
        ({"ended_at": "2024-01-05 07:00:00"}, False),
        ({"ended_at": "bad"}, False),
        ({"started_at": None}, False),
        ({"ride_id": " \t"}, False),
        ({"start_station_id": " "}, False),
        ({"end_station_id": None}, False),
        ({"member_casual": " CASUAL\n"}, True),
        ({"member_casual": "guest"}, False),
        ({"end_lat": "91"}, True),
        ({"trip_date": "?"}, True),
    ],
)
def test_trip_rules(spark, change, kept):
    assert clean_trips(staging(spark, change)).count() == int(kept)


def test_derived_columns(spark):
    row = clean_trips(staging(spark, {"ended_at": "2024-01-05 08:00:02.1", "started_at": "2024-01-05 08:00:00.9"})).first()
    assert (row.ride_duration_minutes, row.ride_hour, row.ride_day_of_week) == (0.02, 8, "Friday")
    assert (row.ride_month, row.ride_year, row.is_weekend, row.time_of_day) == (1, 2024, False, "Morning")
    assert row.trip_distance_km == 11.12
    assert clean_trips(staging(spark, {"end_lng": ""})).first().trip_distance_km is None


def test_first_valid_copy_survives(spark):
    copies = staging(
        spark,
        {"started_at": "2024-01-05 07:00:00", "ended_at": "2024-01-05 06:00:00"},
        {"ride_id": " r1 ", "started_at": "2024-01-05 08:10:00"},
        {"started_at": "2024-01-05 08:20:00"},
    )
    assert [r.started_at for r in clean_trips(copies).collect()] == [dt.datetime(2024, 1, 5, 8, 10)]


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"station_id": " "}, False),
        ({"station_id": None}, False),
        ({"station_name": "\t"}, False),
        ({"lat": None}, False),
        ({"lon": 180.5}, False),
        ({"capacity": None}, False),
        ({"num_bikes_available": -1}, False),
        ({"num_ebikes_available": -1, "is_renting": None}, True),
        ({"event_timestamp": None}, False),
    ],
)
def test_event_rules(spark, change, kept):
    assert clean_events(station_rows(spark, change)).count() == int(kept)


def test_events_are_unique_after_trimming(spark):
    got = clean_events(station_rows(spark, {"station_id": " s"}, {"station_id": "s "}, {"station_id": "t"}))
    assert sorted(r.station_id for r in got.collect()) == ["s", "t"]


def test_batch_reference_keeps_raw_ids(spark):
    ref = stations.batch_station_reference(
        staging(spark, {"start_station_id": "", "end_station_id": "2 ", "end_lat": "x"}, {"end_station_name": "A2"})
    )
    got = {r.batch_station_id: (r.batch_station_name, r.batch_lat) for r in ref.collect()}
    assert got == {"": ("A", 40.7), "1": ("A", 40.7), "2 ": ("B", None), "2": ("A2", 40.8)}


def test_mapping_labels_and_fan_out(spark):
    batch = spark.createDataFrame(
        [("1", "Main St", 1.0, 1.0), ("1 ", " MAIN ST", 1.0, 1.0), ("2", "Other", 2.0, 2.0)],
        "batch_station_id string, batch_station_name string, batch_lat double, batch_lon double",
    )
    stream = spark.createDataFrame(
        [("x", "main st ", 1.0, 1.0, 5), ("y", "Elsewhere", 3.0, 3.0, 5)],
        "stream_station_id string, stream_station_name string, stream_lat double, stream_lon double, capacity bigint",
    )
    got = stations.station_mapping(batch, stream)
    assert "capacity" not in got.columns
    assert sorted((r.batch_station_id, r.stream_station_id) for r in got.collect()) == [
        ("1", "x"),
        ("1 ", "x"),
        ("2", "NO STREAM MATCH"),
        ("NO MATCH BATCH", "y"),
    ]


def test_daily_mart_without_date_has_no_peak(spark):
    trips = clean_trips(staging(spark, {"trip_date": "?"}, {"ride_id": "r2"}))
    got = {r.trip_date: (r.total_trips, r.peak_hour) for r in marts.daily_trip_summary(trips).collect()}
    assert got == {None: (1, None), dt.date(2024, 1, 5): (1, 8)}


def test_station_mart_without_any_date_has_no_average(spark):
    trips = clean_trips(staging(spark, {"trip_date": "?"}))
    mapping = stations.station_mapping(
        stations.batch_station_reference(staging(spark, {})),
        stations.stream_station_reference(station_rows(spark, {})),
    )
    got = marts.station_summary(trips, mapping).collect()
    assert {(r.station_id, r.station_name, r.avg_daily_activity) for r in got} == {("1", "A", None), ("2", "B", None)}


def test_mart_properties(spark):
    trips = clean_trips(staging_trips(spark, SF_DIR)).cache()
    users = marts.station_user_summary(trips).collect()
    assert all(abs(r.member_percentage + r.casual_percentage - 100) <= 0.011 for r in users)
    assert all(r.member_trips + r.casual_trips == r.total_trips for r in users)
    assert sum(r.total_trips for r in users) == trips.count()
    assert sum(r.total_trips for r in marts.daily_trip_summary(trips).collect()) == trips.count()


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("", 2)], "k string, v int")
    assert checks.find_duplicates(df, "k").collect() == [("a", 2)]
    profile = checks.null_profile(df, "t", {"blank_k": checks.is_blank("k"), "null_v": F.col("v").isNull()})
    assert sorted((r.metric, r.value, r.passed) for r in profile.collect()) == [
        ("blank_k", 1, False),
        ("null_v", 1, False),
    ]
    checks.require(checks.expect_rows(df, "t", minimum=3))
    with pytest.raises(checks.CheckFailed, match="rows t.count = 1"):
        checks.require(checks.expect_rows(df, "t", where=F.col("v") == 1, minimum=2))
    with pytest.raises(checks.CheckFailed, match="duplicates t.k = 1"):
        checks.require(checks.expect_unique(df, "t", "k"))


def yearly_trips(spark):
    """Trips dated by year: two thousand day partitions would only cost time here."""
    trips = staging_trips(spark, SF_DIR)
    return trips.withColumn("trip_date", F.concat(F.substring("trip_date", 1, 4), F.lit("-01-01")))


def test_whole_run(spark):
    events = station_events(spark, SF_DIR)
    for _ in range(2):  # a rerun replaces every table
        views = medallion.run_batch(spark, yearly_trips(spark), events)
    counts = {name: spark.table(name).count() for name in views}
    assert counts == {
        "mart_daily_trip_summary": 7,
        "mart_latest_station_status": 15,
        "mart_station_anomaly_monitoring": 987,
        "mart_station_summary": 40,
        "mart_station_user_summary": 10,
        "mart_user_type_summary": 2,
    }
    fact = spark.table("silver.fact_trips_cleaned")
    assert fact.count() == 4233
    one_day = fact.filter("trip_date = date'1998-01-01'").select("ride_id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(trip_date" in one_day
    assert "ReadSchema: struct<ride_id:string>" in one_day


def test_gate_stops_the_run(spark):
    empty = staging_trips(spark, SF_DIR).filter("ride_id = 'none'")
    with pytest.raises(checks.CheckFailed, match="fact_trips"):
        medallion.run_batch(spark, empty, station_events(spark, SF_DIR))
