"""Streams in several micro-batches, with replays and rows out of order, against the batch answer."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tripmart.plans import marts
from tripmart.plans.events import clean_events
from tripmart.plans.ingest import ingest_messages
from tripmart.operators import in_force
from tripmart.sources import read_event_stream, read_station_feed, read_station_feed_stream, versions
from tripmart.sources.schemas import STATION_EVENT, STATION_INFO, STATION_STATUS
from tripmart.streaming import (
    append_information,
    build_events,
    dedupe_stream,
    dedupe_stream_indexed,
    detect_drops_stream,
    feed_events_stream,
    inject_faults,
    latest_status_stream,
    read_deduped,
    read_deduped_indexed,
    read_drops,
    read_latest,
    read_repaired,
    read_split,
    repair_drops_stream,
    split_valid_invalid,
    validate_events,
    write_split_log,
    write_split_stream,
)
from tripmart.sources.versions import last_commit
from tripmart.streaming import slices
from tripmart.streaming.sinks import append_batch
from tripmart.streaming.state import current_slot

from tripmart.showcase import inputs
from tripmart.showcase.queries import QUERIES

from .oracle import spark_rows

NAMES = [f.name for f in STATION_EVENT]
START = dt.datetime(2024, 1, 1)


def event(station, second, bikes, docks=5):
    return (station, f"name {station}", 1.0, 1.0, 100, bikes, docks, 0, True, True, True, START + dt.timedelta(seconds=second))


def sample_events(n=400, seed=3, shuffle_within=12):
    """Events of few stations, one of them hot, slightly out of order, some delivered twice."""
    rng = random.Random(seed)
    rows = [event(rng.choice(["hot", "hot", "a", "b", ""]), 15 * i, rng.choice([-1, 0, 10, 90])) for i in range(n)]
    rows += [r for r in rows if rng.random() < 0.1]
    return sorted(rows, key=lambda r: r[-1] + dt.timedelta(seconds=15 * rng.randrange(shuffle_within)))


def land(spark, rows, path, files):
    """Write the rows as ``files`` JSON files, arriving in order."""
    size = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], STATION_EVENT).coalesce(1)
        part.write.mode("append").json(path)


def stream(spark, path, per_batch=1):
    return read_event_stream(spark, path, options={"maxFilesPerTrigger": str(per_batch)})


def finish(query):
    query.awaitTermination()
    return max(p["batchId"] for p in query.recentProgress)


def test_reasons(spark):
    cases = {
        (None, 1, 1): "station_id is empty",
        ("", -1, -1): "station_id is empty, num_bikes_available is negative, num_docks_available is negative",
        ("  ", 0, 0): None,
        ("s", 0, -1): "num_docks_available is negative",
        ("s", -1, 0): "num_bikes_available is negative",
    }
    rows = [event(s, i, bikes, docks) for i, (s, bikes, docks) in enumerate(cases)]
    df = spark.createDataFrame(rows, STATION_EVENT)
    got = validate_events(df).orderBy("event_timestamp").collect()
    assert [r.error_reason for r in got] == list(cases.values())


def test_quarantine_keeps_the_payload(spark):
    df = spark.createDataFrame([event("s", 0, -1), event("s", 1, 1), (None, *event("s", 2, 0)[1:])], STATION_EVENT)
    valid, invalid = split_valid_invalid(df)
    assert valid.columns == NAMES and valid.count() == 1
    rows = invalid.orderBy("event_timestamp").collect()
    payloads = [json.loads(r.raw_payload) for r in rows]
    assert [list(p) for p in payloads] == [NAMES, NAMES]  # NULL fields are kept
    assert payloads[0]["num_bikes_available"] == -1 and payloads[1]["station_id"] is None


def test_split_stream(spark, tmp_path):
    rows = sample_events()
    land(spark, rows, f"{tmp_path}/in", 4)
    paths = [f"{tmp_path}/{p}" for p in ("valid", "invalid", "checkpoint")]
    assert finish(write_split_stream(stream(spark, f"{tmp_path}/in"), *paths)) == 3
    want = split_valid_invalid(spark.createDataFrame(rows, STATION_EVENT))
    for path, expected in zip(paths, want):
        got = spark.read.parquet(path).drop("batch_id")
        assert spark_rows(got) == spark_rows(expected)


def test_messages_are_decoded_and_split(spark, tmp_path):
    rows = sample_events(60)
    events = spark.createDataFrame(rows, STATION_EVENT)
    events.select(F.to_json(F.struct(*NAMES)).alias("value")).repartition(3).write.text(f"{tmp_path}/topic")
    messages = read_event_stream(spark, f"{tmp_path}/topic", "value string", "text", {"maxFilesPerTrigger": "1"})
    paths = [f"{tmp_path}/{p}" for p in ("valid", "invalid", "checkpoint")]
    finish(ingest_messages(messages, *paths))
    for path, expected in zip(paths, split_valid_invalid(events)):
        assert spark_rows(spark.read.parquet(path).drop("batch_id")) == spark_rows(expected)


def test_a_batch_run_again_leaves_no_copies(spark, tmp_path):
    rows = spark.createDataFrame(sample_events(20), STATION_EVENT)
    for _ in range(2):
        append_batch(rows, f"{tmp_path}/out", 0)
    append_batch(rows, f"{tmp_path}/out", 1)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2 * rows.count()


def test_dedupe_stream(spark, tmp_path):
    """Originals that come late, by more than a day and from a station never seen before, are kept."""
    rows = sample_events()
    rows += [event("new", -200_000, 5), event("new", -200_000, 5), event("hot", -90_000, 7), (None, *event("x", 9, 1)[1:])]
    land(spark, [*rows, rows[0], rows[-1]], f"{tmp_path}/in", 6)
    events = stream(spark, f"{tmp_path}/in")
    keys = ["station_id", "event_timestamp"]
    assert finish(dedupe_stream(events, keys, f"{tmp_path}/out", f"{tmp_path}/checkpoint")) == 5
    got = read_deduped(spark, f"{tmp_path}/out", events.schema)
    assert spark_rows(got) == spark_rows(spark.createDataFrame(rows, STATION_EVENT).distinct())
    with pytest.raises(ValueError):
        dedupe_stream(events, ["station_id"], f"{tmp_path}/out", f"{tmp_path}/checkpoint")


def test_corrupt_messages_are_quarantined_with_their_payload(spark, tmp_path):
    good = json.loads(spark.createDataFrame([event("s", 0, 1)], STATION_EVENT).toJSON().first())
    lines = [
        json.dumps(good),
        json.dumps(good)[:50],
        json.dumps({**good, "num_bikes_available": "abc"}),
        json.dumps({k: v for k, v in good.items() if k != "num_docks_available"}),
        json.dumps({k: v for k, v in good.items() if k not in ("station_name", "capacity", "num_ebikes_available")}),
        "no json",
    ]
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "m.txt").write_text("\n".join(lines))
    messages = read_event_stream(spark, f"{tmp_path}/topic", "value string", "text")
    paths = [f"{tmp_path}/{p}" for p in ("valid", "invalid", "checkpoint")]
    finish(ingest_messages(messages, *paths))
    assert spark.read.parquet(paths[0]).count() == 2
    got = {r.raw_payload: r.error_reason for r in spark.read.parquet(paths[1]).collect()}
    broken = "payload is undecodable"
    assert got == {lines[1]: broken, lines[2]: broken, lines[3]: "num_docks_available is missing", lines[5]: broken}


def test_latest_stream(spark, tmp_path):
    rows = sample_events()
    land(spark, rows, f"{tmp_path}/in", 4)
    last = finish(latest_status_stream(stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = spark.read.parquet(f"{tmp_path}/out/{current_slot(last)}")
    want = marts.latest_station_status(spark.createDataFrame(rows, STATION_EVENT).distinct())
    assert got.columns == NAMES
    assert spark_rows(got) == spark_rows(want)


def run_drops(spark, tmp_path, rows, files, lateness_s):
    land(spark, rows, f"{tmp_path}/in", files)
    events = stream(spark, f"{tmp_path}/in").filter("station_id <> '' and num_bikes_available >= 0")
    return finish(
        detect_drops_stream(events, f"{tmp_path}/out", f"{tmp_path}/cp", marts.compare_events, lateness_s)
    )


def test_drops_stream_equals_batch(spark, tmp_path):
    rows = sample_events()
    last = run_drops(spark, tmp_path, rows, 5, lateness_s=15 * 13)
    assert last == 4
    got = marts.monitoring_columns(read_drops(spark, f"{tmp_path}/out", marts.compare_events, last))
    want = marts.station_anomaly(clean_events(spark.createDataFrame(rows, STATION_EVENT)))
    assert spark_rows(got) == spark_rows(want)
    assert got.filter("anomaly_status <> 'NORMAL'").count() > 0
    # Most rows were released while the stream ran; replays of released rows are the only late ones.
    assert read_drops(spark, f"{tmp_path}/out", marts.compare_events).count() > 0.7 * got.count()
    late = spark.read.parquet(f"{tmp_path}/out/late").select(NAMES)
    assert late.exceptAll(late.distinct()).count() == 0
    assert late.join(got, ["station_id", "event_timestamp"], "left_anti").count() == 0


def test_late_events_find_their_place(spark, tmp_path):
    rows = [event("s", 0, 90), event("s", 100, 80), event("s", 50, 10), event("t", 7, 1), event("s", 200, 70), event("s", 100, 80)]
    last = run_drops(spark, tmp_path, rows, 3, lateness_s=0)
    got = marts.monitoring_columns(read_drops(spark, f"{tmp_path}/out", marts.compare_events, last))
    want = marts.station_anomaly(clean_events(spark.createDataFrame(rows, STATION_EVENT)))
    assert spark_rows(got) == spark_rows(want)
    late = spark.read.parquet(f"{tmp_path}/out/late")
    assert sorted(r.num_bikes_available for r in late.collect()) == [1, 10, 80]


def test_results_of_another_run_are_refused(spark, tmp_path):
    rows = [event("s", 0, 90), event("s", 100, 80)]
    run_drops(spark, tmp_path, rows, 2, lateness_s=0)
    query = detect_drops_stream(stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/other", marts.compare_events)
    with pytest.raises(Exception, match="another run"):
        query.awaitTermination()


def test_ties_are_settled_alike(spark, tmp_path):
    rows = [event("s", 0, 1), event("s", 5, 3), event("s", 5, 9), event("s", 5, 2), event("t", 1, 4), event("t", 1, None)]
    land(spark, rows, f"{tmp_path}/in", 3)
    last = finish(latest_status_stream(stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = spark.read.parquet(f"{tmp_path}/out/{current_slot(last)}")
    want = marts.latest_station_status(spark.createDataFrame(rows, STATION_EVENT))
    assert spark_rows(got) == spark_rows(want)
    assert {r.num_bikes_available for r in got.collect()} == {9, 4}


def test_events_from_feeds(spark, tmp_path):
    (tmp_path / "info").mkdir()
    (tmp_path / "status").mkdir()
    info = [{"station_id": "1", "name": "old"}, {"station_id": 1, "name": "new", "lat": 1.5, "capacity": 9}]
    status = [
        {"station_id": 1, "num_bikes_available": 3.9, "num_docks_available": None, "is_installed": 1, "is_renting": 0},
        {"station_id": "2", "num_bikes_available": "4", "is_installed": True, "is_renting": False, "is_returning": ""},
    ]
    (tmp_path / "info" / "i.json").write_text(json.dumps({"data": {"stations": info}}))
    (tmp_path / "status" / "s.json").write_text(json.dumps({"data": {"stations": status}}))
    known = read_station_feed(spark, str(tmp_path / "info"), STATION_INFO)
    polled = read_station_feed(spark, str(tmp_path / "status"), STATION_STATUS)
    got = build_events(polled, known, last_by=[F.col("position").desc()]).orderBy("station_id")
    assert got.columns == NAMES and got.dtypes == spark.createDataFrame([], STATION_EVENT).dtypes
    assert [tuple(r)[:-1] for r in got.collect()] == [
        ("1", "new", 1.5, None, 9, 3, 0, 0, True, False, False),
        ("2", None, None, None, None, 4, 0, 0, True, False, False),
    ]
    assert all(r.event_timestamp.microsecond % 1000 == 0 for r in got.collect())
    with pytest.raises(ValueError):
        build_events(polled.drop("polled_at"), known)


def test_polls_read_together_keep_their_times(spark, tmp_path):
    """Three polls of one station are three events, also when one run reads them all."""
    (tmp_path / "status").mkdir()
    for k in range(3):
        record = {"station_id": "1", "num_bikes_available": k, "num_docks_available": 1, "is_renting": 1}
        file = tmp_path / "status" / f"{k}.json"
        file.write_text(json.dumps({"data": {"stations": [record]}}))
        os.utime(file, (1_700_000_000 + 60 * k, 1_700_000_000 + 60 * k))
    info = spark.createDataFrame([("1", "one", 1.0, 1.0, 9)], STATION_INFO)
    events = build_events(read_station_feed(spark, str(tmp_path / "status"), STATION_STATUS), info)
    got = clean_events(events).orderBy("event_timestamp").collect()
    assert [r.num_bikes_available for r in got] == [0, 1, 2]


@pytest.mark.parametrize("seed", [0, 7])
def test_faults(spark, seed):
    rows = [(i + 1, *event(f"s{i}", i, 50)) for i in range(120)]
    df = spark.createDataFrame(rows, "pos int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STATION_EVENT))
    got = {r.pos: r for r in inject_faults(df, F.col("pos"), 20, 15, seed).collect()}
    again = {r.pos: r for r in inject_faults(df, F.col("pos"), 20, 15, seed).collect()}
    assert got == again
    for pos, r in got.items():
        spoiled = [r.station_id == "", r.num_bikes_available == -1, r.num_docks_available == -1]
        assert sum(spoiled) == (pos % 20 == 0)
        assert (r.num_bikes_available == 0) == (pos % 15 == 0 and pos % 20 != 0)  # row 60: invalid wins
    assert [tuple(r) for r in inject_faults(df, F.col("pos")).orderBy("pos").collect()] == rows


def journal(spark, path):
    rows = spark.read.parquet(f"{path}/journal").orderBy("batch_id").collect()
    return [(r.messages, r.asked, r.stored, json.loads(r.days), json.loads(r.days_read)) for r in rows]


def test_indexed_dedupe_reads_only_what_it_must(spark, tmp_path):
    """Six batches over several days, with copies and originals of days long past, NULL keys and NULL times."""
    rows = sample_events(300)
    batches = [rows[:100], rows[100:200] + rows[:5], [event("new", 90_000 + k, 5) for k in range(50)]]
    batches += [[event("hot", 180_000 + k, 1) for k in range(50)] + [event("late", -500_000, 1)]]
    batches += [[event("late", -500_000, 1), (None, *event("x", 9, 1)[1:]), (*event("y", 1, 1)[:-1], None)]]
    batches += [[(None, *event("x", 9, 1)[1:]), (*event("y", 1, 1)[:-1], None), event("hot", 180_000, 1)]]
    for part in batches:
        spark.createDataFrame(part, STATION_EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    events = read_event_stream(spark, f"{tmp_path}/in", fmt="parquet", options={"maxFilesPerTrigger": "1"})
    keys = ["station_id", "event_timestamp"]
    out = f"{tmp_path}/out"
    assert finish(dedupe_stream_indexed(events, keys, out, f"{tmp_path}/cp", buckets=16)) == 5
    got = read_deduped_indexed(spark, out, events.schema)
    every = [r for part in batches for r in part]
    assert spark_rows(got) == spark_rows(spark.createDataFrame(every, STATION_EVENT).distinct())
    log = journal(spark, out)
    assert [x[3] for x in log] == [
        ["2024-01-01"], ["2024-01-01"], ["2024-01-02"], ["2023-12-26", "2024-01-03"],
        ["2023-12-26", "2024-01-01", "none"], ["2024-01-01", "2024-01-03", "none"],
    ]
    for _, _, _, touched, read in log:
        assert set(read) <= set(touched)
    # The first batches of a day ask for nothing; copies are asked for in the days where they are.
    assert [x[4] for x in log][0] == [x[4] for x in log][2] == [x[4] for x in log][3] == []
    assert log[1][4] == ["2024-01-01"] and "2023-12-26" in log[4][4] and log[5][2] == 0
    one = read_deduped_indexed(spark, out, events.schema, ["2023-12-26"])
    assert [r.station_id for r in one.collect()] == ["late"] and len(one.inputFiles()) == 1


def test_indexed_dedupe_merges_days_and_runs_again(spark, tmp_path):
    rows = sample_events(240)
    land(spark, rows, f"{tmp_path}/in", 8)
    keys, out = ["station_id", "event_timestamp"], f"{tmp_path}/out"

    def run():
        return finish(
            dedupe_stream_indexed(stream(spark, f"{tmp_path}/in"), keys, out, f"{tmp_path}/cp", buckets=4, merge_at=3)
        )

    assert run() == 7
    at = last_commit(spark, out)
    assert at.number == 7 and max(len(v) for v in at.parts.values()) <= 3
    want = spark_rows(spark.createDataFrame(rows, STATION_EVENT).distinct())
    schema = stream(spark, f"{tmp_path}/in").schema
    assert spark_rows(read_deduped_indexed(spark, out, schema)) == want
    # A batch that wrote everything but whose end the checkpoint does not know runs again.
    for name in ("7", ".7.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    assert run() == 7
    assert spark_rows(read_deduped_indexed(spark, out, schema)) == want
    with pytest.raises(Exception, match="different runs"):
        dedupe_stream_indexed(stream(spark, f"{tmp_path}/in"), keys, out, f"{tmp_path}/other").awaitTermination()


def test_the_last_finished_slot_is_found(spark, tmp_path):
    with pytest.raises(ValueError):
        read_latest(spark, f"{tmp_path}/out")
    rows = sample_events()
    land(spark, rows, f"{tmp_path}/in", 3)
    finish(latest_status_stream(stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp"))
    want = marts.latest_station_status(spark.createDataFrame(rows, STATION_EVENT).distinct())
    assert spark_rows(read_latest(spark, f"{tmp_path}/out")) == spark_rows(want)
    # A later batch that dies half-way through its slot leaves the finished one.
    spark.createDataFrame(rows[:1], STATION_EVENT).write.mode("overwrite").parquet(f"{tmp_path}/out/{current_slot(3)}")
    assert spark_rows(read_latest(spark, f"{tmp_path}/out")) == spark_rows(want)


def compare(events, before):
    return marts.compare_events(events, before=before)


def run_repaired(spark, tmp_path, batches):
    for part in batches:
        spark.createDataFrame(part, STATION_EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    events = read_event_stream(spark, f"{tmp_path}/in", fmt="parquet", options={"maxFilesPerTrigger": "1"})
    out = f"{tmp_path}/out"
    assert finish(repair_drops_stream(events, out, f"{tmp_path}/cp", compare, marts.COMPARED)) == len(batches) - 1
    return out, events.schema


def test_late_rows_are_repaired_in_place(spark, tmp_path):
    hour = 3600
    batches = [
        [event("s", 0, 90), event("s", 10, 80), event("t", 5, 5), event("s", 3 * hour, 70)],
        [event("s", 5 * hour, 20), event("t", 6, 1), event("u", 7 * hour, 3)],
        # Into an empty slice between two, into a stored slice, before all, and after the last one.
        [event("s", hour + 1, 10), event("s", 5, 1), event("s", -50, 99), event("s", 5 * hour + 9, 1)],
        # Copies, one of a row of this batch; a new station's rows in two slices, the later one first.
        [event("s", 5, 1), event("s", 10, 80), event("v", 2 * hour, 60), event("v", 9, 61), event("v", 9, 61)],
        # Two late rows of one station in neighbouring slices, and one whose next slice is far.
        [event("s", 2 * hour, 66), event("s", 2 * hour + 30, 5), event("s", hour + 2, 70), event("t", 3 * hour, 5)],
        [event("t", 4, 90), event("u", 8 * hour, 1)],
    ]
    out, schema = run_repaired(spark, tmp_path, batches)
    got = marts.monitoring_columns(read_repaired(spark, out, schema, compare))
    every = spark.createDataFrame([r for part in batches for r in part], STATION_EVENT)
    want = marts.station_anomaly(clean_events(every))
    assert spark_rows(got) == spark_rows(want)
    assert got.filter("anomaly_status <> 'NORMAL'").count() > 2
    # A read compares nothing; the last batch wrote only its late row's slice and the next one of that station.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    at = last_commit(spark, out)
    assert json.loads(at.note)["rewritten"] == ["2024-01-01T00", "2024-01-01T03"]
    assert at.parts["changes", "2024-01-01T01"] == (4,) and at.parts["changes", "2024-01-01T08"] == (5,)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [event(rng.choice("aab"), 400 * i + rng.randrange(300), rng.choice([0, 10, 90])) for i in range(120)]
    rows += rng.sample(rows, 20)
    rng.shuffle(rows)
    out, schema = run_repaired(spark, tmp_path, [rows[k : k + 47] for k in range(0, len(rows), 47)])
    got = marts.monitoring_columns(read_repaired(spark, out, schema, compare))
    want = marts.station_anomaly(clean_events(spark.createDataFrame(rows, STATION_EVENT)))
    assert spark_rows(got) == spark_rows(want)


def days_of(spark, path, kind):
    return [p for k, p in last_commit(spark, path).parts if k == f"{kind}_days"]


def test_split_log_merges_batches_into_days(spark, tmp_path):
    rows = [(*event("s", 1, 1)[:-1], None), *sample_events(300), event("s", 90_000, 1), event("", 180_000, 1)]
    rows += [event("s", 91_000 + k, 3) for k in range(20)]
    land(spark, rows, f"{tmp_path}/in", 7)
    out = f"{tmp_path}/out"
    query = write_split_log(stream(spark, f"{tmp_path}/in"), out, f"{tmp_path}/cp", compact_every=2, merge_at=2)
    assert finish(query) == 6
    for kind, expected in zip(("valid", "invalid"), split_valid_invalid(spark.createDataFrame(rows, STATION_EVENT))):
        assert spark_rows(read_split(spark, out, kind)) == spark_rows(expected)
        day = expected.where("event_timestamp >= '2024-01-02' AND event_timestamp < '2024-01-03'")
        assert spark_rows(read_split(spark, out, kind, ["2024-01-02"])) == spark_rows(day)
    at = last_commit(spark, out)
    assert at.names("valid") == ["batch-000000000006"], "the last batch is pending, the others are in days"
    assert max(len(v) for (k, _), v in at.parts.items() if k == "valid_days") <= 2
    assert "none" in days_of(spark, out, "invalid")
    # A day's files only; batches that were merged are not opened.
    assert len(read_split(spark, out, "valid").inputFiles()) < 10


def test_a_merge_that_dies_before_its_commit(spark, tmp_path, monkeypatch):
    """Everything is written, but the commit: readers see the table of the batch before, and the next run ends it."""
    rows = sample_events(200)
    land(spark, rows, f"{tmp_path}/in", 5)
    out, real = f"{tmp_path}/out", versions.commit

    def run():
        return write_split_log(stream(spark, f"{tmp_path}/in"), out, f"{tmp_path}/cp", compact_every=3)

    def dying(spark_, path, new):
        if new.number == 2:
            raise OSError("the driver is lost")
        real(spark_, path, new)

    monkeypatch.setattr(versions, "commit", dying)
    with pytest.raises(Exception, match="the driver is lost"):
        run().awaitTermination()
    assert last_commit(spark, out).number == 1 and (tmp_path / "out" / "valid_days" / "version=2").exists()
    size = -(-len(rows) // 5)
    want = split_valid_invalid(spark.createDataFrame(rows[: 2 * size], STATION_EVENT))[0]
    assert spark_rows(read_split(spark, out)) == spark_rows(want)

    monkeypatch.setattr(versions, "commit", real)
    finish(run())
    for kind, expected in zip(("valid", "invalid"), split_valid_invalid(spark.createDataFrame(rows, STATION_EVENT))):
        assert spark_rows(read_split(spark, out, kind)) == spark_rows(expected)


def poll_file(path, second, *records):
    path.parent.mkdir(exist_ok=True)
    path.write_text(json.dumps({"data": {"stations": list(records)}}))
    os.utime(path, (1_700_000_000 + second, 1_700_000_000 + second))


def test_feed_stream_with_versions_of_the_information(spark, tmp_path):
    """Times of the files, whatever batch reads them; a version that comes while the stream rests counts at once."""
    zero = dt.datetime.fromtimestamp(1_700_000_000, dt.timezone.utc).replace(tzinfo=None)

    def run(per_batch):
        polls = read_station_feed_stream(spark, f"{tmp_path}/status", STATION_STATUS, polls_per_batch=per_batch)
        sink = lambda events, batch: append_batch(events, f"{tmp_path}/out", batch)
        return finish(feed_events_stream(polls, f"{tmp_path}/info", f"{tmp_path}/cp", sink, invalid_every=3))

    def info(name):
        return spark.createDataFrame([("1", name, 1.0, 2.0, 9)], STATION_INFO)

    record = {"num_bikes_available": 4, "num_docks_available": "2", "is_renting": 1}
    append_information(info("old"), f"{tmp_path}/info", zero)
    poll_file(tmp_path / "status" / "z.json", -5, {"station_id": 1, **record})
    poll_file(tmp_path / "status" / "a.json", 0, {"station_id": "1", **record}, {"station_id": 2, **record})
    assert run(1) == 1
    append_information(info("new"), f"{tmp_path}/info", zero + dt.timedelta(seconds=60))
    poll_file(tmp_path / "status" / "b.json", 59, {"station_id": 1, **record})
    poll_file(tmp_path / "status" / "c.json", 60, *[{"station_id": 1, **record}] * 3)
    assert run(None) == 2
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    got = sorted(((r.event_timestamp - zero).total_seconds(), r.station_id, r.station_name, r.capacity) for r in rows)
    spoiled = [r for r in rows if r.station_id == "" or r.num_bikes_available == -1 or r.num_docks_available == -1]
    assert len(spoiled) == 1 and (spoiled[0].event_timestamp - zero).total_seconds() == 60
    assert [g[0] for g in got] == [-5, 0, 0, 59, 60, 60, 60]
    assert [(g[0], g[2]) for g in got if g[0] < 60] == [(-5, None), (0, "old"), (0, None), (59, "old")]
    assert {g[2] for g in got if g[0] == 60} == {"new"}


def test_versions_in_force(spark):
    times = spark.createDataFrame([("a", 0), ("b", 10), ("c", 11), ("d", 99)], "poll string, at int")
    known = spark.createDataFrame([(5, "x"), (10, "y"), (10, "z"), (50, "w")], "since int, name string")
    got = {r.poll: r.since for r in in_force(times, known, "at", "since").collect()}
    assert got == {"a": None, "b": 10, "c": 10, "d": 50}


def test_spans_of_several_files_arrive_as_one_batch_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "FILE_ROWS", 100)
    rows = spark.range(3000).selectExpr("id", "timestampadd(SECOND, int(id) * 60, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts")
    batches = []
    stream = inputs.arriving(rows.repartition(5), "ts", "id")
    running = stream.writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True)
    running.foreachBatch(lambda df, n: batches.append(sorted(r.id for r in df.collect()))).start().awaitTermination()
    assert len(batches) == inputs.ARRIVALS
    assert sorted(i for b in batches for i in b) == list(range(3000))
    assert all(b[0] > a[0] and b[-1] > a[-1] for a, b in zip(batches, batches[1:], strict=False))


def test_dedupe_stream_gathers_the_rows_of_a_day(spark, tmp_path):
    rows = [event(f"s{i % 40}", 7 * i, 1) for i in range(400)]
    land(spark, rows, f"{tmp_path}/in", 2)
    events = read_event_stream(spark, f"{tmp_path}/in", options={"maxFilesPerTrigger": "1"})
    finish(dedupe_stream(events, ["station_id", "event_timestamp"], f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    for batch in ("batch_id=0", "batch_id=1"):
        files = list((tmp_path / "out" / batch).glob("event_day=2024-01-01/*.parquet"))
        assert len(files) == 1
    assert read_deduped(spark, f"{tmp_path}/out", events.schema).count() == 400


def test_a_share_of_the_repaired_stream_comes_late(spark, tmp_path, monkeypatch):
    """Over a table of a day one row in twenty is late at least, not only those about the borders of batches."""
    sf, batches, step = f"{tmp_path}/sf", [], slices._step
    columns = ("id AS event_id", "id * 7 % 1500 AS user_id", "'click' AS event_type", "double(id * 37 % 101) AS value")
    spark.range(21_600).selectExpr(*columns).write.parquet(f"{sf}/events.parquet")

    def watched(batch, *rest):
        batches.append([tuple(r) for r in batch.select("station_id", "event_timestamp").collect()])
        step(batch, *rest)

    monkeypatch.setattr(slices, "_step", watched)
    got = QUERIES["stream_drops_repaired"](spark, sf)
    want = marts.station_anomaly(clean_events(inputs.station_events(spark, sf)))
    assert spark_rows(got) == spark_rows(want)
    assert len(batches) == inputs.ARRIVALS
    newest, late = {}, 0
    for rows in batches:
        late += sum(s in newest and t <= newest[s] for s, t in rows)
        for s, t in rows:
            newest[s] = max(t, newest.get(s, t))
    assert late > sum(map(len, batches)) / 20
