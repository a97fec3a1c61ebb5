"""Published layers, refreshed marts, observed writes, sketches, buckets and the ledger of loaded files."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tripmart.operators import distinct_sketch, merge_sketches, sketch_error
from tripmart.plans import checks, ingest, marts, publish, refresh
from tripmart.sources import write_bucketed
from tripmart.sources.files import list_files, read_raw_trips
from tripmart.sources.schemas import RAW_TRIP, STATION_EVENT
from tripmart.sources.versions import PART, Commit, commit, last_commit, read_parts, write_parts

from .oracle import spark_rows
from .test_sources import RAW_HEADER, trip_line
from .test_streaming import event

# ---------------------------------------------------------------- versioned parts


def test_a_commit_is_seen_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], f"x int, {PART} string")
    schema = df.drop(PART).schema
    assert last_commit(spark, path) == Commit()
    assert read_parts(spark, path, "t", schema, Commit()).count() == 0
    assert write_parts(df, path, "t", 0) == ["a", "b"]
    assert last_commit(spark, path).number == -1, "written, but not committed"
    commit(spark, path, Commit(0, {("t", "a"): (0,), ("t", "b"): (0,)}, "first"))
    write_parts(df.where("x = 3"), path, "t", 1)
    commit(spark, path, Commit(1, {("t", "a"): (0,), ("t", "b"): (0, 1)}))
    at = last_commit(spark, path)
    assert (at.number, at.note, at.names("t")) == (1, None, ["a", "b"])
    assert sorted(r.x for r in read_parts(spark, path, "t", schema, at).collect()) == [1, 2, 3, 3]
    assert [r.x for r in read_parts(spark, path, "t", schema, at, since=0).collect()] == [3]
    assert len(read_parts(spark, path, "t", schema, at, ["a", "other"]).inputFiles()) == 1
    before = last_commit(spark, path, before=1)
    assert (before.number, before.note) == (0, "first")
    commit(spark, path, Commit(2))
    assert last_commit(spark, path) == Commit(2) and last_commit(spark, path, before=2).number == 1


# ---------------------------------------------------------------- write, audit, publish


def drafts(spark, rows):
    df = spark.createDataFrame(rows, "ride string, day date")
    return {"rides": publish.Draft(df, "day", ["ride"]), "names": publish.Draft(df.select("ride"))}


def no_duplicates(tables):
    return checks.union(
        checks.expect_unique(tables["rides"], "rides", "ride"), checks.expect_rows(tables["names"], "names")
    )


def test_a_failing_audit_leaves_the_published_version(spark, tmp_path):
    path, day = str(tmp_path), dt.date(2024, 1, 1)
    with pytest.raises(ValueError):
        publish.audits(spark, path)
    good = [("a", day), ("b", day + dt.timedelta(1)), ("c", None)]
    assert publish.publish(spark, path, drafts(spark, good), no_duplicates) == 0
    held = publish.published(spark, path, "rides")
    with pytest.raises(checks.CheckFailed, match="duplicates rides.ride = 1"):
        publish.publish(spark, path, drafts(spark, [*good, ("a", day)]), no_duplicates)
    for table in (held, publish.published(spark, path, "rides")):
        assert sorted((r.ride, r.day) for r in table.collect()) == sorted(good)
    failed = publish.audits(spark, path).where("NOT passed").collect()
    assert [(r.number, r.metric, r.value) for r in failed] == [(1, "ride", 1)]
    # The next run takes the place of the failed one; a gate that is off publishes in spite of it.
    assert publish.publish(spark, path, drafts(spark, [("z", day)]), no_duplicates) == 1
    assert [r.ride for r in publish.published(spark, path, "names").collect()] == ["z"]
    assert sorted(r.ride for r in held.collect()) == ["a", "b", "c"], "a reader keeps the version it has"
    assert publish.publish(spark, path, drafts(spark, [("q", day)] * 2), no_duplicates, gate=False) == 2
    with pytest.raises(ValueError, match="no published table other"):
        publish.published(spark, path, "other")


def test_a_run_that_dies_before_the_commit(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path), dt.date(2024, 1, 1)
    publish.publish(spark, path, drafts(spark, [("a", day)]), no_duplicates)

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(publish, "commit", dies)
    with pytest.raises(OSError):
        publish.publish(spark, path, drafts(spark, [("b", day)]), no_duplicates)
    assert [r.ride for r in publish.published(spark, path, "rides").collect()] == ["a"]


# ---------------------------------------------------------------- refresh


def trips(seed, n, days):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        day = rng.choice(days)
        start = dt.datetime(2024, 1, 1 + (day or 0), rng.randrange(24), 30)
        minutes = rng.choice([None, 0.02, 12.5, 700.0])
        end = start + dt.timedelta(minutes=minutes or 5)
        names = [rng.choice(["S1", "S2", "S3"]) for _ in range(2)]
        date = None if day is None else start.date()
        rows.append((f"r{seed}-{k}", start, end, *names, f"name {names[0]}", rng.choice(["member", "casual"]), date, minutes))
    return rows


TRIPS = (
    "ride_id string, started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, end_station_id string, "
    "start_station_name string, member_casual string, trip_date date, ride_duration_minutes double"
)


def test_loads_add_up_to_the_full_marts(spark, tmp_path):
    path = str(tmp_path)
    first, second = trips(1, 120, [0, 1, 2, 3, None]), trips(2, 60, [2, 5, None])
    mapping = spark.createDataFrame(
        [("S1", "one", "x"), ("S2", "two", "y"), ("S2", "again", "y")],
        "batch_station_id string, batch_station_name string, stream_station_name string",
    )
    refresh.refresh(spark, path, spark.createDataFrame(first, TRIPS), "monday")
    untouched = {k: v for k, v in last_commit(spark, path).parts.items() if k[1] in ("2024-01-01", "2024-01-02")}
    touched = refresh.refresh(spark, path, spark.createDataFrame(second, TRIPS), "tuesday")
    assert touched == ["2024-01-03", "2024-01-06", "none"]
    assert refresh.refresh(spark, path, spark.createDataFrame(second, TRIPS), "tuesday") == [], "a load counts once"
    at = last_commit(spark, path)
    assert untouched and all(at.parts[k] == v for k, v in untouched.items())
    both = spark.createDataFrame(first + second, TRIPS).withColumn("ride_hour", F.hour("started_at"))
    pairs = [
        (refresh.daily_trip_summary(spark, path), marts.daily_trip_summary(both)),
        (refresh.station_summary(spark, path, mapping), marts.station_summary(both, mapping)),
        (refresh.station_user_summary(spark, path), marts.station_user_summary(both)),
        (refresh.user_type_summary(spark, path), marts.user_type_summary(both)),
    ]
    for got, want in pairs:
        assert got.dtypes == want.dtypes
        assert spark_rows(got) == spark_rows(want)


# ---------------------------------------------------------------- observed writes, sketches, buckets


def test_observed_figures_come_from_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "k int, s string").repartition(3)
    rules = {"no_s": checks.is_blank("s"), "no_k": F.col("k").isNull()}
    jobs = []

    def write(rows):
        jobs.append(rows)
        rows.write.parquet(f"{tmp_path}/out")

    got = checks.observed_write(df, write, "t", rules, minimum=4)
    assert [tuple(r) for r in got.collect()] == [
        ("rows", "t", "count", 3, False), ("invalid values", "t", "no_s", 2, False), ("invalid values", "t", "no_k", 0, True),
    ]
    assert len(jobs) == 1 and spark.read.parquet(f"{tmp_path}/out").count() == 3
    with pytest.raises(checks.CheckFailed):
        checks.require(got)


def test_sketches_of_days_give_distinct_counts_of_months(spark):
    df = spark.range(60_000).selectExpr("id % 30 AS day", "(id * 7919) % 20011 AS rider", "CAST(NULL AS STRING) AS none")
    days = distinct_sketch(df, ["day"], {"riders": "rider", "none": "none"}, lg_k=12)
    (row,) = merge_sketches(days, [], ["riders", "none"]).collect()
    assert row.none == 0 and row.riders != 20011
    assert abs(row.riders - 20011) <= sketch_error(12) * 20011
    some = merge_sketches(days.where("day < 3"), ["day"], ["riders"]).collect()
    for r in some:
        assert abs(r.riders - 2000) <= sketch_error(12) * 2000


def test_bucketed_events_are_not_shuffled(spark, tmp_path):
    rng = random.Random(6)
    rows = [event(rng.choice("aaab"), 500 * k + rng.randrange(400), rng.choice([0, 10, 90])) for k in range(300)]
    df = spark.createDataFrame(rows, STATION_EVENT).withColumn("event_hour", F.date_trunc("hour", "event_timestamp"))
    table = write_bucketed(df, "default.events_in_buckets", ["station_id", "event_hour"], ["event_timestamp"], path=f"{tmp_path}/t")
    got = marts.station_anomaly(table, laid_out="event_hour")
    assert spark_rows(got) == spark_rows(marts.station_anomaly(df.drop("event_hour")))
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    below = re.split(r"Exchange hashpartitioning", plan)
    # What is shuffled is one row per station and hour; every scan of events lies below a window without an exchange.
    assert plan.count("FileScan parquet") <= 2
    for part in below[1:]:
        assert "Filter isnull(" in part.split("FileScan")[0] or "FileScan" not in part, plan


# ---------------------------------------------------------------- raw files


def test_a_ledger_spares_what_was_loaded(spark, tmp_path):
    drop, path = tmp_path / "drop", str(tmp_path / "table")
    drop.mkdir()

    def put(name, *lines):
        (drop / name).write_text("\n".join([RAW_HEADER, *lines]) + "\n")

    def rides():
        return sorted((r.ride_id, r.start_station_name) for r in ingest.read_raw_loads(spark, path).collect())

    assert ingest.load_raw_ledger(spark, str(drop), path) == []
    put("a.csv", trip_line("a1"), trip_line("a2"), trip_line("a1", name="again"))
    put("b.csv", trip_line("b1"))
    assert [x.rsplit("/", 1)[1] for x in ingest.load_raw_ledger(spark, str(drop), path)] == ["a.csv", "b.csv"]
    number = last_commit(spark, path).number
    assert ingest.load_raw_ledger(spark, str(drop), path) == [] and last_commit(spark, path).number == number
    # A changed file, a new one with a ride that is stored, one without rows, and one that is no CSV.
    put("a.csv", trip_line("a1", name="changed"), trip_line("a3"))
    put("c.csv", trip_line("b1", name="later"), trip_line("c1"))
    put("d.csv")
    (drop / "e.txt").write_text("ignored")
    assert [x.rsplit("/", 1)[1] for x in ingest.load_raw_ledger(spark, str(drop), path)] == ["a.csv", "c.csv", "d.csv"]
    assert rides() == [("a1", "A"), ("a2", "A"), ("a3", "A"), ("b1", "A"), ("c1", "A")]
    ledger = {(r.path.rsplit("/", 1)[1], r.load): (r.rows, r.first_ride, r.last_ride) for r in ingest.read_ledger(spark, path).collect()}
    assert ledger == {
        ("a.csv", 0): (3, "a1", "a2"), ("b.csv", 0): (1, "b1", "b1"),
        ("a.csv", 1): (2, "a1", "a3"), ("c.csv", 1): (2, "b1", "c1"), ("d.csv", 1): (0, None, None),
    }
    assert ingest.read_raw_loads(spark, path).schema == RAW_TRIP


def test_a_load_that_dies_before_its_commit_is_repeated(spark, tmp_path, monkeypatch):
    drop, path = tmp_path / "drop", str(tmp_path / "table")
    drop.mkdir()
    (drop / "a.csv").write_text(f"{RAW_HEADER}\n{trip_line('r1')}\n")
    real = ingest.commit
    monkeypatch.setattr(ingest, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest.load_raw_ledger(spark, str(drop), path)
    assert ingest.read_raw_loads(spark, path).count() == 0
    monkeypatch.setattr(ingest, "commit", real)
    ingest.load_raw_ledger(spark, str(drop), path)
    assert ingest.read_raw_loads(spark, path).count() == 1


def test_headers_take_one_line_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿" + RAW_HEADER + "\n" + "\n".join(trip_line(f"r{k}") for k in range(50)) + "\n")
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text('"ride_id",' + RAW_HEADER.split(",", 1)[1] + "\n" + trip_line("x") + "\n")
    assert sorted(r.path.rsplit("/", 1)[1] for r in list_files(spark, str(tmp_path)).collect()) == ["a.csv", "c.csv"]
    got = read_raw_trips(spark, str(tmp_path))
    assert got.count() == 51 and got.where("start_station_name = 'A'").count() == 51
    with pytest.raises(ValueError):
        read_raw_trips(spark, str(tmp_path), "*.none")


def test_a_silver_layer_is_audited_with_its_marts(spark, tmp_path):
    """Without a valid event the marts over events would be empty: the layer is not published."""
    path = str(tmp_path)
    staging = spark.createDataFrame(
        [("r1", "x", "2024-01-05 08:00:00", "2024-01-05 09:00:00", "A", "1", "B", "2", "40.7", "-74", "40.8", "-74", "member", "2024-01-05")],
        [*RAW_HEADER.split(","), "trip_date"],
    )
    events = spark.createDataFrame([event("s", 0, 5)], STATION_EVENT)
    silver = publish.publish_silver(spark, path, staging, events)
    assert silver.trips.count() == silver.events.count() == 1 and spark.table("mart_daily_trip_summary").count() == 1
    with pytest.raises(checks.CheckFailed, match="mart_latest_station_status"):
        publish.publish_silver(spark, path, staging, events.where("false"))
    assert publish.published_silver(spark, path).events.count() == 1


def test_rides_of_a_load_are_not_gathered_again(spark, tmp_path, monkeypatch):
    asked = {}

    def write(df, path, kind, number, cluster=(), **options):
        asked[kind] = options
        return write_parts(df, path, kind, number, cluster, **options)

    monkeypatch.setattr(ingest, "write_parts", write)
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.csv").write_text("\n".join([RAW_HEADER, *[trip_line(f"r{i}") for i in range(50)]]) + "\n")
    ingest.load_raw_ledger(spark, str(drop), str(tmp_path / "table"))
    assert asked[ingest.RIDES] == {"gather": False}
    assert ingest.read_raw_loads(spark, str(tmp_path / "table")).count() == 50


def test_a_drop_that_is_stored_is_asked_for_its_ids_alone(spark, tmp_path, monkeypatch):
    drop, table = tmp_path / "drop", "default.asked_by_ids"
    drop.mkdir()
    (drop / "a.csv").write_text("\n".join([RAW_HEADER, trip_line("r1"), trip_line("r2")]) + "\n")
    ingest.load_raw(spark, str(drop), table, location=str(tmp_path / "table"))
    with monkeypatch.context() as m:
        m.setattr(ingest, "new_rows", lambda *a: pytest.fail("whole rows were compared"))
        ingest.load_raw(spark, str(drop), table)
    (drop / "b.csv").write_text("\n".join([RAW_HEADER, trip_line("r2"), trip_line("r3")]) + "\n")
    ingest.load_raw(spark, str(drop), table)
    assert sorted(r.ride_id for r in spark.table(table).collect()) == ["r1", "r2", "r3"]
