"""One query per operator, table, mart, check and question. Each reads its whole input tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import blank_to_null, fold, safe_date, safe_double, safe_long, safe_timestamp
from ..operators import (
    append_new,
    count_distinct_multi,
    count_where,
    dedupe_first,
    distinct_sketch,
    drop_anomaly,
    full_outer_on,
    latest_per_key,
    merge_sketches,
    peak_bucket,
    share_of_total,
    sketch_error,
    stack_sides,
    top_k,
    total_order,
    with_previous,
)
from ..plans import checks, ingest, marts, medallion, publish, questions, refresh
from ..plans.events import clean_events, valid_events
from ..plans.stations import batch_station_reference, station_mapping, stream_station_reference
from ..plans.trips import clean_trips, enrich_trips, type_trips, valid_trips
from ..sources import (
    decode_events,
    ensure_layers,
    extract_range,
    read_staging_trips,
    read_station_feed,
    read_station_feed_stream,
    register_views,
    scratch_path,
    time_in_path,
    trip_dates,
    write_bucketed,
    write_daily,
    write_table,
)
from ..sources.schemas import RAW_TRIP, STATION_EVENT, STATION_INFO, STATION_STATUS
from ..sources.tables import LAYERS
from ..streaming.sinks import append_batch
from ..streaming import (
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
from .inputs import event_stream, late_event_stream, staging_trips, station_event_stream, station_events, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- tables and marts


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return clean_trips(staging_trips(spark, sf))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return clean_events(station_events(spark, sf))


def _round_positions(df: DataFrame) -> DataFrame:
    """Means of doubles depend on the order of summation in their last bits."""
    return df.withColumns({c: F.round(c, 6) for c in ("batch_lat", "batch_lon")})


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return split_valid_invalid(station_events(spark, sf))[0]


def _mapping(spark: SparkSession, sf: str) -> DataFrame:
    batch = batch_station_reference(staging_trips(spark, sf))
    return station_mapping(batch, stream_station_reference(_valid(spark, sf)))


@query
def fact_trips_cleaned(spark, sf):
    return _trips(spark, sf)


@query
def fact_events_cleaned(spark, sf):
    return _events(spark, sf)


@query
def events_valid(spark, sf):
    return _valid(spark, sf)


@query
def events_invalid(spark, sf):
    return split_valid_invalid(station_events(spark, sf))[1]


@query
def dim_batch_station_reference(spark, sf):
    return _round_positions(batch_station_reference(staging_trips(spark, sf)))


@query
def dim_stream_station_reference(spark, sf):
    return stream_station_reference(_valid(spark, sf))


@query
def dim_station_mapping(spark, sf):
    return _round_positions(_mapping(spark, sf))


@query
def mart_daily_trip_summary(spark, sf):
    return marts.daily_trip_summary(_trips(spark, sf))


@query
def mart_latest_station_status(spark, sf):
    return marts.latest_station_status(_events(spark, sf))


@query
def mart_station_anomaly(spark, sf):
    return marts.station_anomaly(_events(spark, sf))


@query
def mart_station_summary(spark, sf):
    return marts.station_summary(_trips(spark, sf), _mapping(spark, sf))


@query
def mart_station_user_summary(spark, sf):
    return marts.station_user_summary(_trips(spark, sf))


@query
def mart_user_type_summary(spark, sf):
    return marts.user_type_summary(_trips(spark, sf))


# ---------------------------------------------------------------- dashboard questions


@query
def q_monthly_trend(spark, sf):
    return questions.monthly_trend(mart_daily_trip_summary(spark, sf))


@query
def q_top_stations(spark, sf):
    return questions.top_stations(mart_station_summary(spark, sf))


@query
def q_bikes_available(spark, sf):
    return questions.bikes_available(mart_latest_station_status(spark, sf))


@query
def q_active_stations(spark, sf):
    return questions.active_stations(mart_latest_station_status(spark, sf))


@query
def q_anomalies_by_station(spark, sf):
    return questions.anomalies_by_station(mart_station_anomaly(spark, sf))


# ---------------------------------------------------------------- quality checks


@query
def dq_source_rows(spark, sf):
    orders = table(spark, sf, "orders")
    in_range = (F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1997-01-01")
    return checks.expect_rows(orders, "orders", where=in_range)


def _written(spark: SparkSession, sf: str) -> medallion.Silver:
    """Dimensions and facts, written as tables in namespaces of their own and read back."""
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    ensure_layers(spark, [prefix + layer for layer in LAYERS], scratch_path(spark, "tables"))
    trips = write_table(staging_trips(spark, sf), f"{prefix}staging.fact_trips")
    events = write_table(station_events(spark, sf), f"{prefix}staging.fact_station_events")
    return medallion.build_silver(trips, events, *medallion.build_dimensions(trips, events, prefix), prefix)


@query
def medallion_fact_trips(spark, sf):
    return _written(spark, sf).trips


@query
def medallion_fact_events(spark, sf):
    return _written(spark, sf).events


@query
def medallion_mapping(spark, sf):
    return _round_positions(_written(spark, sf).mapping)


def _stored(spark: SparkSession, sf: str) -> medallion.Silver:
    """The facts and the mapping, each built once and written as plain files for checks that read them often."""
    base = scratch_path(spark, "facts")
    parts = {"trips": _trips(spark, sf), "events": _events(spark, sf), "mapping": _mapping(spark, sf)}
    for name, df in parts.items():
        df.write.parquet(f"{base}/{name}")
    return medallion.Silver(**{name: spark.read.parquet(f"{base}/{name}") for name in parts})


@query
def dq_row_counts(spark, sf):
    silver = _stored(spark, sf)
    tables = {
        "staging_trips": staging_trips(spark, sf),
        "staging_events": station_events(spark, sf),
        "fact_trips_cleaned": silver.trips,
        "fact_events_cleaned": silver.events,
        "dim_station_mapping": silver.mapping,
    }
    return checks.row_counts(tables, minimum=1)


@query
def dq_mart_counts(spark, sf):
    gold = medallion.gold(_stored(spark, sf))
    gold["mart_station_anomaly"] = gold.pop("mart_station_anomaly_monitoring")
    return checks.row_counts(gold, minimum=1)


@query
def dq_duplicates(spark, sf):
    return checks.find_duplicates(type_trips(staging_trips(spark, sf), ["ride_id"]), "ride_id")


@query
def dq_unique_ride(spark, sf):
    return checks.expect_unique(_trips(spark, sf), "fact_trips_cleaned", "ride_id")


@query
def dq_null_profile(spark, sf):
    checked = ["ride_id", "started_at", "ended_at", "start_station_id", "end_station_id"]
    typed = type_trips(staging_trips(spark, sf), checked)
    return checks.null_profile(typed, "staging_trips", checks.trip_rules())


@query
def dq_fact_null_profile(spark, sf):
    return checks.null_profile(_trips(spark, sf), "fact_trips_cleaned", checks.trip_rules())


@query
def dq_fact_duplicates(spark, sf):
    return checks.find_duplicates(_trips(spark, sf), "ride_id")


# ---------------------------------------------------------------- cleaning and filters


@query
def blank_to_null_fold(spark, sf):
    trips = staging_trips(spark, sf)
    cleaned = {c: blank_to_null(F.col(c)) for c in ("ride_id", "rideable_type", "start_station_id", "end_station_id")}
    return trips.select(
        *[c.alias(n) for n, c in cleaned.items()],
        fold(F.col("member_casual")).alias("member_casual"),
        F.coalesce(cleaned["rideable_type"], F.lit("unspecified")).alias("rideable_label"),
        "trip_date",
    )


@query
def safe_cast(spark, sf):
    return staging_trips(spark, sf).select(
        "ride_id",
        safe_timestamp(F.col("started_at")).alias("started_at"),
        safe_timestamp(F.col("ended_at")).alias("ended_at"),
        safe_double(F.col("end_lat")).alias("end_lat"),
        safe_double(F.col("rideable_type")).alias("not_a_number"),
        safe_long(F.substring("trip_date", 1, 4)).alias("year"),
        safe_long(F.col("end_lng")).alias("not_a_long"),
        safe_date(F.col("trip_date")).alias("trip_date"),
    )


@query
def trip_enrich(spark, sf):
    return enrich_trips(type_trips(staging_trips(spark, sf)))


@query
def fact_trips_one_day(spark, sf):
    """One day of the fact: the scan is filtered by the raw text of the day."""
    return clean_trips(staging_trips(spark, sf), day="1996-06-15")


@query
def valid_trips_only(spark, sf):
    return valid_trips(type_trips(staging_trips(spark, sf)))


@query
def valid_events_only(spark, sf):
    return valid_events(station_events(spark, sf))


# ---------------------------------------------------------------- pick one row, windows


@query
def dedupe_first_line(spark, sf):
    lines = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = total_order(lines, [F.col("l_shipdate").asc_nulls_first()], skip=[*keys, "l_shipdate"])
    return dedupe_first(lines, keys, order)


@query
def dedupe_event(spark, sf):
    events = station_events(spark, sf)
    keys = ["station_id", "event_timestamp"]
    return dedupe_first(events, keys, total_order(events, [], skip=keys))


def _coarse(events: DataFrame) -> DataFrame:
    """Times by the day, so most users have several events of the same, latest time."""
    return events.withColumn("ts", F.date_trunc("day", "ts").cast(events.schema["ts"].dataType))


@query
def latest_per_user(spark, sf):
    return latest_per_key(_coarse(table(spark, sf, "events")), ["user_id"], "ts")


@query
def peak_hour_per_user(spark, sf):
    hours = table(spark, sf, "events").select("user_id", F.hour("ts").alias("peak_hour"))
    return peak_bucket(hours, ["user_id"], "peak_hour")


def _user_history(spark: SparkSession, sf: str) -> DataFrame:
    return with_previous(
        table(spark, sf, "events"),
        ["user_id"],
        ["ts", "event_id"],
        ["value", "event_type", "ts"],
        slice_by=F.date_trunc("day", "ts"),
    )


@query
def previous_per_user(spark, sf):
    return _user_history(spark, sf)


@query
def drop_per_user(spark, sf):
    return drop_anomaly(_user_history(spark, sf), "value", "ts", max_gap_s=3600, min_drop=50).select(
        "event_id", "user_id", "time_diff_seconds", F.round("value_drop", 2).alias("value_drop"), "anomaly_status"
    )


# ---------------------------------------------------------------- aggregates, order, sides


@query
def share_of_orders(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return share_of_total(counted, "n", "percentage")


@query
def count_distinct_orders(spark, sf):
    columns = {"customers": "o_custkey", "priorities": "o_orderpriority"}
    return count_distinct_multi(table(spark, sf, "orders"), ["o_orderstatus"], columns)


@query
def count_if_lines(spark, sf):
    conditions = {
        "discounted": F.col("l_discount") > 0.05,
        "bulk": F.col("l_quantity") >= 30,
        "odd_part": F.col("l_partkey") % 2 == 1,
    }
    return count_where(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], conditions)


@query
def top_customers(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return top_k(counted, "orders", ["o_custkey"], 10)


@query
def unpivot_sides(spark, sf):
    sides = {
        "START": {"station_id": F.col("start_station_id"), "station_name": F.col("start_station_name")},
        "END": {"station_id": F.col("end_station_id"), "station_name": F.col("end_station_name")},
    }
    return stack_sides(staging_trips(spark, sf), sides, keep=["ride_id"], tag="activity_type")


# ---------------------------------------------------------------- joins and extracts


@query
def full_outer_fold(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.format_string(" Key %d", "c_custkey").alias("c_label")
    )
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", F.format_string("KEY %d\t", F.col("s_suppkey") * 20).alias("s_label")
    )
    joined = full_outer_on(customers, suppliers, fold(F.col("c_label")), fold(F.col("s_label")))
    return joined.select(
        "c_custkey",
        "s_suppkey",
        F.coalesce("c_label", F.lit("NO CUSTOMER")).alias("c_label"),
        F.coalesce("s_label", F.lit("NO SUPPLIER")).alias("s_label"),
    )


def _status(events: DataFrame) -> DataFrame:
    """``events`` rows as records of a status feed; some counts and flags are missing."""
    return events.select(
        "event_id",
        F.col("user_id").alias("station_id"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("num_bikes_available"),
        (500 - F.floor("value")).alias("num_docks_available"),
        (F.col("event_id") % 20).cast("string").alias("num_ebikes_available"),
        (F.col("event_id") % 2).alias("is_installed"),
        F.when(F.col("event_type") != "view", F.lit("true")).alias("is_renting"),
        (F.col("event_type") != "signup").alias("is_returning"),
        "ts",
    )


def _feed_events(spark: SparkSession, sf: str) -> DataFrame:
    info = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lat"),
        (-F.col("s_acctbal")).alias("lon"),
        F.col("s_nationkey").alias("capacity"),
    )
    now = F.date_trunc("millisecond", "ts").cast("timestamp_ntz")
    return build_events(
        _status(table(spark, sf, "events")), info, now=now, last_by=[F.col("name").desc()], keep=["event_id"]
    )


@query
def enrich_status(spark, sf):
    return _feed_events(spark, sf)


@query
def inject_faults_feed(spark, sf):
    """Polls of 500 records each; the field hit rotates so that SQL can follow it."""
    position = F.col("event_id") % 500 + 1
    choice = (F.floor(position / 20) % 3).cast("int")
    return inject_faults(
        _feed_events(spark, sf), position, invalid_every=20, anomaly_every=15, choice=choice
    )


@query
def raw_drop_load(spark, sf):
    """A drop of CSV files whose headers differ in order and in further columns, loaded twice into a raw table.

    The order of copies within the drop is that of its files, so one copy of each ride goes into it.
    """
    raw = staging_trips(spark, sf).select(*[f.name for f in RAW_TRIP]).filter(blank_to_null(F.col("ride_id")).isNotNull())
    raw = dedupe_first(raw, ["ride_id"], total_order(raw, [], skip=["ride_id"]))
    drop, table_ = scratch_path(spark, "drop"), f"default.raw_{uuid.uuid4().hex[:12]}"
    half = F.pmod(F.xxhash64("ride_id"), F.lit(2)) == 0
    raw.filter(half).write.option("header", True).csv(f"{drop}/a")
    swapped = raw.filter(~half).select(F.lit("x").alias("extra"), *reversed(raw.columns))
    swapped.write.option("header", True).csv(f"{drop}/b")
    for _ in range(2):
        ingest.load_raw(spark, f"{drop}/*", table_, location=scratch_path(spark, "raw"))
    return spark.table(table_)


@query
def station_feed_rows(spark, sf):
    """Status snapshots written as feed files, one per region of the suppliers, and read again."""
    records = F.struct(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lat"),
        (-F.col("s_acctbal")).alias("lon"),
        F.col("s_nationkey").cast("int").alias("capacity"),
    )
    suppliers = table(spark, sf, "supplier").groupBy("s_nationkey")
    polls = suppliers.agg(F.sort_array(F.collect_list(records)).alias("stations"))
    path = scratch_path(spark, "feed")
    snapshots = polls.select("s_nationkey", F.struct("stations").alias("data"))
    snapshots.repartition("s_nationkey").write.partitionBy("s_nationkey").json(path)
    feed = read_station_feed(spark, path, STATION_INFO)
    return feed.select("position", *[f.name for f in STATION_INFO])


@query
def append_new_lines(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("line_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    stored = lines.filter(F.col("l_partkey") % 2 == 0)
    stored = dedupe_first(stored, ["line_key"], total_order(stored, [], skip=["line_key"]))
    incoming = lines.filter(F.col("l_partkey") % 2 == 1).withColumn("arrived", F.col("l_shipdate"))
    return append_new(stored, incoming, "line_key", arrival=["arrived"])


@query
def extract_range_orders(spark, sf):
    return extract_range(table(spark, sf, "orders"), "1996-01-01", "1998-01-01", "o_orderdate", ordered=True)


@query
def order_dates(spark, sf):
    return trip_dates(table(spark, sf, "orders"), "1996-01-01", "1998-01-01", "o_orderdate", "order_date")


@query
def daily_csv_roundtrip(spark, sf):
    """Raw trips written as one folder per day and read back as staging text."""
    staging = staging_trips(spark, sf)
    raw = staging.select(
        *[
            {"timestamp_ntz": safe_timestamp, "double": safe_double}
            .get(f.dataType.simpleString(), lambda c: c)(F.col(f.name))
            .alias(f.name)
            for f in RAW_TRIP
        ]
    )
    landing = scratch_path(spark, "landing")
    write_daily(raw, landing)
    return read_staging_trips(spark, landing)


# ---------------------------------------------------------------- validation and streams


@query
def validate_reasons(spark, sf):
    events = station_events(spark, sf).withColumn("station_id", F.trim("station_id"))
    spoiled = events.withColumn(
        "num_docks_available",
        F.when(F.col("num_ebikes_available") == 7, -1).otherwise(F.col("num_docks_available")),
    )
    return validate_events(spoiled).select(
        "station_id", "num_bikes_available", "num_docks_available", "event_timestamp", "error_reason"
    )


@query
def decode_payload(spark, sf):
    """Events encoded as JSON messages and decoded again."""
    events = station_events(spark, sf)
    message = F.to_json(F.struct(*events.columns)).cast("binary").alias("value")
    return decode_events(events.select(message))


@query
def decode_corrupt(spark, sf):
    """Quarantine of messages of which some are cut off, hold a text for a number, or lack a required field."""
    events = station_events(spark, sf)
    whole = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    kind = F.unix_timestamp(F.col("event_timestamp").cast("timestamp")) / 4 % 10
    spoiled = (
        F.when(kind == 1, F.substring(whole, 1, 40))
        .when(kind == 2, F.regexp_replace(whole, '"num_bikes_available":-?[0-9]+', '"num_bikes_available":"abc"'))
        .when(kind == 3, F.regexp_replace(whole, ',"is_renting":(true|false)', ""))
        .otherwise(whole)
    )
    rows = events.select(spoiled.alias("value"), F.col("event_timestamp").alias("sent"))
    _, invalid = split_valid_invalid(decode_events(rows, keep_payload=True))
    return invalid.select("error_reason", "raw_payload")


def _finish(streaming_query) -> int:
    """Wait for an ``availableNow`` run of several micro-batches; returns the number of the last."""
    streaming_query.awaitTermination()
    with_rows = [p["batchId"] for p in streaming_query.recentProgress if p["numInputRows"]]
    if len(with_rows) < 4:
        raise AssertionError(f"only {len(with_rows)} micro-batches had rows")
    return max(with_rows)


@query
def stream_split_valid(spark, sf):
    out = scratch_path(spark, "split")
    _finish(
        write_split_stream(
            station_event_stream(spark, sf), f"{out}/valid", f"{out}/invalid", f"{out}/checkpoint"
        )
    )
    return spark.read.parquet(f"{out}/valid").drop("batch_id")


@query
def stream_split_invalid(spark, sf):
    out = scratch_path(spark, "split")
    _finish(
        write_split_stream(
            station_event_stream(spark, sf), f"{out}/valid", f"{out}/invalid", f"{out}/checkpoint"
        )
    )
    return spark.read.parquet(f"{out}/invalid").drop("batch_id")


@query
def stream_dedupe(spark, sf):
    out = scratch_path(spark, "dedupe")
    events = station_event_stream(spark, sf)
    _finish(dedupe_stream(events, ["station_id", "event_timestamp"], f"{out}/events", f"{out}/checkpoint"))
    return read_deduped(spark, f"{out}/events", events.schema)


@query
def stream_dedupe_indexed(spark, sf):
    """Events of many days, with originals and copies that come weeks late; an index of the keys is asked first."""
    out = scratch_path(spark, "dedupe-indexed")
    events = late_event_stream(spark, sf)
    _finish(dedupe_stream_indexed(events, ["event_id", "ts"], f"{out}/events", f"{out}/checkpoint", "ts", merge_at=3))
    return read_deduped_indexed(spark, f"{out}/events", events.schema)


@query
def stream_latest(spark, sf):
    out = scratch_path(spark, "latest")
    events = _coarse(event_stream(spark, sf))
    _finish(latest_status_stream(events, f"{out}/latest", f"{out}/checkpoint", "user_id", "ts"))
    return read_latest(spark, f"{out}/latest")


def _drops(spark: SparkSession, sf: str, lateness_s: int) -> DataFrame:
    """The anomaly mart from a stream, with the rows still waiting at its end released."""
    out = scratch_path(spark, "drops")
    events = valid_events(station_event_stream(spark, sf)).withColumns(
        {c: F.trim(c) for c in ("station_id", "station_name")}
    )
    last = _finish(detect_drops_stream(events, out, f"{out}/checkpoint", marts.compare_events, lateness_s))
    return marts.monitoring_columns(read_drops(spark, out, marts.compare_events, last))


@query
def stream_drops(spark, sf):
    return _drops(spark, sf, lateness_s=600)


@query
def stream_drops_late(spark, sf):
    """No lateness is waited for, so many rows come late and are put in their place when read."""
    return _drops(spark, sf, lateness_s=0)


def _compare(events: DataFrame, before: DataFrame | None) -> DataFrame:
    return marts.compare_events(events, before=before)


@query
def stream_drops_repaired(spark, sf):
    """The anomaly mart after a stream in which many rows come late; it is exact after each batch."""
    out = scratch_path(spark, "repaired")
    events = valid_events(station_event_stream(spark, sf, late=True)).withColumns(
        {c: F.trim(c) for c in ("station_id", "station_name")}
    )
    _finish(repair_drops_stream(events, out, f"{out}/checkpoint", _compare, marts.COMPARED))
    return marts.monitoring_columns(read_repaired(spark, out, events.schema, _compare))


def _split_log(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Six micro-batches, merged into days after the fourth: four of them in days, two still as they came."""
    out = scratch_path(spark, "splitlog")
    _finish(write_split_log(station_event_stream(spark, sf), out, f"{out}/checkpoint", compact_every=4))
    return read_split(spark, out, kind)


@query
def stream_split_compacted(spark, sf):
    return _split_log(spark, sf, "valid")


@query
def stream_quarantine_compacted(spark, sf):
    return _split_log(spark, sf, "invalid")


#: Polls of the feed that the ``events`` table makes up, the time between them, and when the second version of the
#: station information comes into force.
POLLS, FIRST_POLL, POLL_GAP = 6, datetime(2024, 3, 1), timedelta(minutes=5)
SECOND_VERSION = FIRST_POLL + timedelta(minutes=12)


def _land_polls(spark: SparkSession, sf: str, path: str) -> None:
    """Status polls, one file each: every station that has events in the poll, ordered by id."""
    records = F.struct(
        F.col("user_id").cast("string").alias("station_id"),
        F.max(F.floor("value")).cast("string").alias("num_bikes_available"),
        F.when(F.count("*") % 7 != 0, F.count("*").cast("string")).alias("num_docks_available"),
        (F.sum("event_id") % 20).cast("string").alias("num_ebikes_available"),
        (F.count("*") % 2).cast("string").alias("is_installed"),
        (F.col("user_id") % 3 != 0).cast("string").alias("is_renting"),
        F.lit("true").alias("is_returning"),
    )
    events = table(spark, sf, "events").withColumn("poll", (F.col("event_id") % POLLS).cast("int"))
    stations = events.groupBy("poll", "user_id").agg(records.alias("record"))
    polls = stations.groupBy("poll").agg(F.sort_array(F.collect_list("record")).alias("stations")).persist()
    for k in range(POLLS):
        at = FIRST_POLL + k * POLL_GAP
        one = polls.where(F.col("poll") == k).select(F.struct("stations").alias("data"))
        one.coalesce(1).write.json(f"{path}/poll-{at:%Y%m%dT%H%M%S}")
    polls.unpersist()


@query
def feed_stream_events(spark, sf):
    """Six polls as micro-batches of one or two, each matched with the station information in force at its time."""
    out = scratch_path(spark, "feed-stream")
    _land_polls(spark, sf, f"{out}/status")
    info = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lat"),
        (-F.col("s_acctbal")).alias("lon"),
        F.col("s_nationkey").alias("capacity"),
    )
    append_information(info, f"{out}/information", datetime(2024, 1, 1))
    second = info.where("station_id % 7 <> 0").withColumn("name", F.concat("name", F.lit(" B")))
    append_information(second, f"{out}/information", SECOND_VERSION)
    taken = time_in_path("/poll-([0-9T]+)/", "yyyyMMdd'T'HHmmss")
    polls = read_station_feed_stream(spark, f"{out}/status/*", STATION_STATUS, taken, polls_per_batch=1)
    _finish(
        feed_events_stream(
            polls,
            f"{out}/information",
            f"{out}/checkpoint",
            lambda events, batch: append_batch(events, f"{out}/events", batch),
            last_by=[F.col("name").desc()],
            invalid_every=20,
            anomaly_every=15,
            choice=(F.floor(F.col("position") / 20) % 3).cast("int"),
        )
    )
    return spark.read.parquet(f"{out}/events").select(*[f.name for f in STATION_EVENT])


# ---------------------------------------------------------------- publishing, refresh, layout


@query
def published_fact_trips(spark, sf):
    """The trip fact as published, after a second run whose checks failed."""
    path = scratch_path(spark, "published")
    trips, events = staging_trips(spark, sf), station_events(spark, sf)
    publish.publish_silver(spark, path, trips, events, unit="month")
    try:
        publish.publish_silver(spark, path, trips.where("ride_id = ' '"), events, unit="month")
    except checks.CheckFailed:
        return publish.published(spark, path, publish.TRIPS)
    raise AssertionError("a layer without trips was published")


def _refreshed(spark: SparkSession, sf: str) -> str:
    """Sums of two loads: rides whose first copy is of before June 2000, and all later ones."""
    path = scratch_path(spark, "refresh")
    first = F.min("trip_date").over(Window.partitionBy("ride_id"))
    # Both loads read the staged rows as they were written: they are made and put in order of rides once.
    staged = scratch_path(spark, "staged")
    staging_trips(spark, sf).withColumn("__first", first).write.parquet(staged)
    staging = spark.read.parquet(staged)
    for load, part in (("early", F.col("__first") < "2000-06-01"), ("late", F.col("__first") >= "2000-06-01")):
        refresh.refresh(spark, path, clean_trips(staging.where(part).drop("__first")), load, unit="month")
    return path


@query
def mart_daily_incremental(spark, sf):
    return refresh.daily_trip_summary(spark, _refreshed(spark, sf))


@query
def mart_station_incremental(spark, sf):
    return refresh.station_summary(spark, _refreshed(spark, sf), _mapping(spark, sf))


@query
def mart_station_user_incremental(spark, sf):
    return refresh.station_user_summary(spark, _refreshed(spark, sf))


@query
def mart_user_type_incremental(spark, sf):
    return refresh.user_type_summary(spark, _refreshed(spark, sf))


@query
def dq_observed(spark, sf):
    """Row count and null profile of staged trips, from the job that writes them."""
    checked = ["ride_id", "started_at", "ended_at", "start_station_id", "end_station_id"]
    typed = type_trips(staging_trips(spark, sf), checked)
    path = scratch_path(spark, "observed")
    return checks.observed_write(typed, lambda df: df.write.parquet(path), "staging_trips", checks.trip_rules())


@query
def distinct_stations_sketch(spark, sf):
    """Distinct stations and rides per month: exact, and whether the estimate from sketches of days is near enough."""
    trips = _trips(spark, sf).where(F.col("trip_date").isNotNull())
    columns = {"stations": "start_station_id", "rides": "ride_id"}
    path = scratch_path(spark, "sketches")
    # Both counts read the columns that they need as they were written: the fact is built once.
    trips.select("trip_date", *columns.values()).write.parquet(f"{path}/trips")
    trips = spark.read.parquet(f"{path}/trips")
    path = f"{path}/days"
    distinct_sketch(trips, ["trip_date"], columns).write.parquet(path)
    month = F.trunc("trip_date", "month").alias("trip_month")
    names = list(columns)
    estimated = merge_sketches(spark.read.parquet(path).withColumn("trip_month", month), ["trip_month"], names)
    exact = count_distinct_multi(trips.withColumn("trip_month", month), ["trip_month"], columns)
    both = exact.join(estimated.withColumnsRenamed({n: f"{n}_estimate" for n in names}), "trip_month")
    near = [(F.abs(F.col(f"{n}_estimate") - F.col(n)) <= sketch_error() * F.col(n)).alias(f"{n}_near") for n in names]
    return both.select("trip_month", *names, *near)


@query
def mart_station_anomaly_bucketed(spark, sf):
    """The anomaly mart over an event fact that lies in buckets by station and hour."""
    fact = _events(spark, sf).withColumn("event_hour", F.date_trunc("hour", "event_timestamp"))
    name = f"default.events_{uuid.uuid4().hex[:12]}"
    location = scratch_path(spark, "bucketed")
    stored = write_bucketed(fact, name, ["station_id", "event_hour"], ["event_timestamp"], path=location)
    return marts.station_anomaly(stored, laid_out="event_hour")


@query
def raw_drop_ledger(spark, sf):
    """A drop that grows and is loaded after each change, with a file that is loaded and then changed."""
    raw = staging_trips(spark, sf).select(*[f.name for f in RAW_TRIP]).filter(blank_to_null(F.col("ride_id")).isNotNull())
    raw = dedupe_first(raw, ["ride_id"], total_order(raw, [], skip=["ride_id"]))
    drop, path = scratch_path(spark, "drop"), scratch_path(spark, "ledger")
    third = F.pmod(F.xxhash64("ride_id"), F.lit(3))
    raw.filter(third == 0).write.option("header", True).csv(f"{drop}/a")
    raw.filter(third == 1).limit(100).write.option("header", True).csv(f"{drop}/b")
    ingest.load_raw_ledger(spark, f"{drop}/*", path)
    raw.filter(third == 1).write.mode("overwrite").option("header", True).csv(f"{drop}/b")
    swapped = raw.filter(third == 2).select(F.lit("x").alias("extra"), *reversed(raw.columns))
    swapped.write.option("header", True).csv(f"{drop}/c")
    ingest.load_raw_ledger(spark, f"{drop}/*", path)
    if ingest.load_raw_ledger(spark, f"{drop}/*", path):
        raise AssertionError("a drop without changes was read again")
    return ingest.read_raw_loads(spark, path)


@query
def view_daily_trips(spark, sf):
    """The daily mart by the name of its view."""
    name = f"mart_daily_{uuid.uuid4().hex[:12]}"
    register_views({name: marts.daily_trip_summary(_trips(spark, sf))})
    return spark.sql(f"SELECT * FROM {name}")
