"""Readers and writers on hand-written files."""

import datetime as dt
import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripmart.operators import append_new
from tripmart.plans import checks, ingest
from tripmart.sources import (
    day_predicates,
    decode_events,
    ensure_layers,
    extract_range,
    read_raw_trips,
    read_staging_trips,
    read_station_feed,
    scratch_path,
    trip_dates,
    write_daily,
    write_fact,
)
from tripmart.sources.files import ARRIVAL
from tripmart.sources.schemas import RAW_TRIP, STAGING_TRIP, STATION_EVENT, STATION_INFO

HEADER = ",".join(f.name for f in STAGING_TRIP)
RAW_HEADER = ",".join(f.name for f in RAW_TRIP)


def trip_line(ride_id, start="2024-01-05 08:00:00", name="A", station="5303.10", end="2024-01-05 09:00:00"):
    return f"{ride_id},classic_bike,{start},{end},{name},{station},B,2,40.7,-74.0,40.8,-74.0,member"


def test_raw_trips_by_pattern(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{RAW_HEADER}\n{trip_line('r1')}\n{trip_line('r2', name='')}\n")
    (tmp_path / "b.csv").write_text(f"{RAW_HEADER}\n{trip_line('r1', name='later')}\n")
    (tmp_path / "c.txt").write_text("ignored\n")
    got = read_raw_trips(spark, str(tmp_path))
    assert got.schema == RAW_TRIP
    rows = got.orderBy("ride_id", "start_station_name").collect()
    assert [(r.ride_id, r.start_station_name, r.start_station_id) for r in rows] == [
        ("r1", "A", "5303.10"),
        ("r1", "later", "5303.10"),
        ("r2", None, "5303.10"),
    ]
    assert rows[0].started_at == dt.datetime(2024, 1, 5, 8)


def test_raw_trips_by_header_name(spark, tmp_path):
    names = ["extra", *reversed([f.name for f in RAW_TRIP])]
    cells = {"ride_id": "r1", "started_at": "2024-01-05 08:00:00", "start_lat": "nan", "end_lat": "x", "end_lng": "1.5",
             "start_station_name": "NA", "end_station_name": '"B, C"'}
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(cells.get(n, "") for n in names) + "\n")
    row = read_raw_trips(spark, str(tmp_path)).first()
    assert (row.ride_id, row.started_at, row.end_lng) == ("r1", dt.datetime(2024, 1, 5, 8), 1.5)
    assert (row.start_lat, row.end_lat, row.start_station_name, row.end_station_name) == (None, None, None, "B, C")
    (tmp_path / "b.csv").write_text(f"{RAW_HEADER}\n{trip_line('r2')}\n")
    rows = {r.ride_id: r for r in read_raw_trips(spark, str(tmp_path)).collect()}
    assert rows["r1"] == row and rows["r2"].start_station_id == "5303.10"
    (tmp_path / "c.csv").write_text("ride_id,started_at\nr3,\n")
    with pytest.raises(ValueError, match="no column rideable_type"):
        read_raw_trips(spark, str(tmp_path))


def test_first_arrival_over_files_and_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{RAW_HEADER}\n{trip_line('r1', name='z')}\n{trip_line('r1', name='b')}\n")
    (tmp_path / "b.csv").write_text(f"{RAW_HEADER}\n{trip_line('r1', name='a')}\n{trip_line('r2', name='c')}\n")
    incoming = read_raw_trips(spark, str(tmp_path), with_arrival=True)
    stored = spark.createDataFrame([], RAW_TRIP)
    got = append_new(stored, incoming, "ride_id", ARRIVAL)
    assert sorted((r.ride_id, r.start_station_name) for r in got.collect()) == [("r1", "z"), ("r2", "c")]


def test_staging_cells(spark, tmp_path):
    day = tmp_path / "year=2024" / "month=01" / "day=05"
    day.mkdir(parents=True)
    lines = [
        HEADER,
        'r1,classic_bike,s,e,"A ""q"", B",1,"",2,,-74.0,40.8,-74.0, member ,2024-01-05',
        "",
        "r2,short",
        "r3,,,,,,,,,,,,,2024-01-05,extra,cells",
    ]
    (day / "trips.csv").write_text("\n".join(lines) + "\n")
    got = read_staging_trips(spark, str(tmp_path))
    assert got.columns == [f.name for f in STAGING_TRIP]
    rows = {r.ride_id: r for r in got.collect()}
    assert sorted(rows) == ["r1", "r2", "r3"]
    assert (rows["r1"].start_station_name, rows["r1"].end_station_name, rows["r1"].start_lat) == ('A "q", B', "", "")
    assert rows["r1"].member_casual == " member "
    assert (rows["r2"].rideable_type, rows["r2"].trip_date) == ("short", "")
    assert rows["r3"].trip_date == "2024-01-05"


def raw(spark, *rides):
    base = dict.fromkeys([f.name for f in RAW_TRIP])
    rows = [tuple({**base, "ride_id": r, "started_at": t, "start_station_name": n}.values()) for r, t, n in rides]
    return spark.createDataFrame(rows, RAW_TRIP)


def test_daily_folders_and_rerun(spark, tmp_path):
    path = str(tmp_path / "landing")
    first, second = dt.datetime(2024, 1, 5, 23, 59), dt.datetime(2024, 2, 10)
    write_daily(raw(spark, (" r1", first, 'A "q", B'), ("r2", second, None), ("r3", None, "x")), path)
    folders = sorted(str(p.relative_to(path)) for p in Path(path).glob("year=*/month=*/day=*"))
    assert folders == ["year=2024/month=01/day=05", "year=2024/month=02/day=10"]
    write_daily(raw(spark, ("r4", second, None)), path)  # replaces its own day only
    got = {r.ride_id: r for r in read_staging_trips(spark, path).collect()}
    assert sorted(got) == [" r1", "r4"]
    assert (got[" r1"].start_station_name, got[" r1"].trip_date) == ('A "q", B', "2024-01-05")
    assert got["r4"].start_station_name == ""


def test_range_and_dates(spark):
    t = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2), None]
    df = raw(spark, *[(str(i), x, None) for i, x in enumerate(t)])
    got = extract_range(df, "2024-01-01", "2024-01-02", ordered=True)
    assert [r.ride_id for r in got.collect()] == ["0", "1"]
    assert [r.trip_date for r in trip_dates(df, "2024-01-01", "2025-01-01").collect()] == [
        date(2024, 1, 1),
        date(2024, 1, 2),
    ]


def test_day_predicates():
    got = day_predicates(date(2024, 2, 28), date(2024, 3, 1))
    assert got == [
        "started_at >= TIMESTAMP '2024-02-28 00:00:00' AND started_at < TIMESTAMP '2024-02-29 00:00:00'",
        "started_at >= TIMESTAMP '2024-02-29 00:00:00' AND started_at < TIMESTAMP '2024-03-01 00:00:00'",
    ]


def test_station_feed(spark, tmp_path):
    stations = [{"station_id": 7, "name": "A", "lat": 1, "lon": 2.5, "extra": []}, {"station_id": "x"}]
    (tmp_path / "poll.json").write_text(json.dumps({"ttl": 5, "data": {"stations": stations}}, indent=1))
    got = read_station_feed(spark, str(tmp_path), STATION_INFO).orderBy("position").collect()
    assert [(r.position, r.station_id, r.name, r.lat, r.capacity) for r in got] == [
        (1, "7", "A", 1.0, None),
        (2, "x", None, None, None),
    ]


def test_decode(spark):
    payload = json.dumps({"station_id": "1", "capacity": 5, "event_timestamp": "2024-01-01T00:00:00.123"})
    got = decode_events(spark.createDataFrame([(1, bytearray(payload.encode()))], "offset int, value binary"))
    assert got.columns == ["offset", *[f.name for f in STATION_EVENT]]
    row = got.first()
    assert (row.station_id, row.capacity, row.lat) == ("1", 5, None)
    assert row.event_timestamp == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    with pytest.raises(ValueError, match="xml"):
        decode_events(got, "station_id", "xml")


def test_avro_needs_its_package(spark):
    df = spark.createDataFrame([(bytearray(b""),)], "value binary")
    try:
        decoded = decode_events(df, fmt="avro")
    except (AnalysisException, TypeError) as e:
        pytest.skip(f"spark-avro is not on the class path: {type(e).__name__}")
    assert decoded.columns == [f.name for f in STATION_EVENT]


def test_fact_layout(spark):
    ensure_layers(spark)
    df = spark.range(100).select("id", (F.col("id") % 3).alias("day"), (-F.col("id")).alias("k"))
    back = write_fact(df, "silver.layout_check", "day", ["k"])
    assert back.count() == 100
    assert [r.partition for r in spark.sql("show partitions silver.layout_check").collect()] == [
        "day=0",
        "day=1",
        "day=2",
    ]


def test_scratch_is_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base) and b.startswith(base)


def test_batch_ingestion(spark, tmp_path):
    drop, landing = tmp_path / "drop", str(tmp_path / "landing")
    drop.mkdir()
    (drop / "a.csv").write_text(f"{RAW_HEADER}\n{trip_line('r1')}\n{trip_line('r1', name='copy')}\n")
    ensure_layers(spark, ["raw"])
    for _ in range(2):  # loading the same drop again adds nothing
        ingest.load_raw(spark, str(drop), "raw.trips")
    (drop / "b.csv").write_text(f"{RAW_HEADER}\n{trip_line('r1', name='later')}\n{trip_line('r2', start='2025-01-01')}\n")
    ingest.load_raw(spark, str(drop), "raw.trips")
    stored = spark.table("raw.trips")
    assert sorted((r.ride_id, r.start_station_name) for r in stored.collect()) == [("r1", "A"), ("r2", "A")]
    ingest.land_trips(stored, landing, "2024-01-01", "2025-01-01")
    got = read_staging_trips(spark, landing).collect()
    assert [(r.ride_id, r.started_at, r.start_station_id, r.trip_date) for r in got] == [
        ("r1", "2024-01-05 08:00:00.000000", "5303.10", "2024-01-05")
    ]
    with pytest.raises(checks.CheckFailed, match="raw trips"):
        ingest.land_trips(stored, landing, "2030-01-01", "2031-01-01")
