"""Trips and station events derived from ``lineitem`` and ``events``.

Dirt is injected by arithmetic on the keys: blank and padded ids, copies, unreadable times, impossible
durations, empty coordinates, unknown rider types, negative counts, replayed messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import read_event_stream, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_START = "timestampadd(SECOND, (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 86400, l_shipdate)"
_RIDE_SECONDS = (
    "(l_partkey * 37 + l_suppkey * 11) % 7200 - 300 + CASE WHEN l_partkey % 53 = 0 THEN 86400 ELSE 0 END"
)
_TO_TEXT = "date_format({ts}, 'yyyy-MM-dd HH:mm:ss') || '.' || lpad(CAST({ms} AS STRING), 3, '0')"


def _coordinate(whole: str, base: int, station: str, step: int) -> str:
    return f"'{whole}.' || lpad(CAST({base} + {station} * {step} AS STRING), 4, '0')"


_FROM = "(l_suppkey % 40)"
_TO = "((l_partkey + l_suppkey) % 40)"

TRIP_TEXT = {
    "ride_id": "CASE WHEN l_partkey % 97 = 0 THEN '  ' ELSE concat(' R', l_orderkey, '-', l_linenumber) END",
    "rideable_type": "CASE l_returnflag WHEN 'A' THEN 'electric_bike' WHEN 'N' THEN '' ELSE 'classic_bike' END",
    "started_at": "CASE WHEN l_partkey % 101 = 0 THEN 'bad' ELSE "
    + _TO_TEXT.format(ts=_START, ms="l_orderkey % 1000")
    + " END",
    "ended_at": _TO_TEXT.format(ts=f"timestampadd(SECOND, {_RIDE_SECONDS}, {_START})", ms="l_partkey % 1000"),
    "start_station_name": f"concat('Station ', {_FROM})",
    "start_station_id": f"CASE WHEN {_FROM} = 39 THEN '' ELSE concat('S', {_FROM}) END",
    "end_station_name": f"concat('Station ', {_TO})",
    "end_station_id": f"concat('S', {_TO}, ' ')",
    "start_lat": _coordinate("40", 6000, _FROM, 71),
    "start_lng": _coordinate("-73", 8000, _FROM, 37),
    "end_lat": f"CASE WHEN l_partkey % 89 = 0 THEN '' ELSE {_coordinate('40', 6000, _TO, 71)} END",
    "end_lng": _coordinate("-73", 8000, _TO, 37),
    "member_casual": "CASE WHEN l_linestatus = 'O' THEN ' Member ' WHEN l_partkey % 83 = 0 THEN 'unknown' "
    "ELSE 'CASUAL' END",
    "trip_date": "date_format(l_shipdate, 'yyyy-MM-dd')",
}


def staging_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """14 text columns, one row per ``lineitem`` row."""
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in TRIP_TEXT.items()])


_STATION = "(user_id % 30)"

EVENT_COLUMNS = {
    "station_id": f"CASE WHEN event_id % 211 = 0 THEN ' ' ELSE concat('X', {_STATION}) END",
    "station_name": f"CASE WHEN event_id % 223 = 0 THEN NULL ELSE concat(' STATION ', {_STATION} + 20, ' ') END",
    "lat": f"CAST({_coordinate('40', 6000, _STATION, 71)} AS DOUBLE)",
    "lon": f"CAST({_coordinate('-73', 8000, _STATION, 37)} AS DOUBLE)",
    "capacity": "500",
    "num_bikes_available": "CASE WHEN event_id % 227 = 0 THEN -1 ELSE CAST(floor(value) AS INT) END",
    "num_docks_available": "CAST(500 - floor(value) AS INT)",
    "num_ebikes_available": "CAST(event_id % 20 AS INT)",
    "is_installed": "event_type <> 'error'",
    "is_renting": "event_type <> 'signup'",
    "is_returning": "event_type <> 'view'",
    "event_timestamp": "timestampadd(SECOND, event_id * 4, TIMESTAMP_NTZ'2024-01-01 00:00:00')",
}


def as_station_events(events: DataFrame) -> DataFrame:
    """Station events from ``events`` rows, every 50th delivered twice. Works on a stream, too."""
    copies = F.when(F.col("event_id") % 50 == 0, 2).otherwise(1)
    delivered = events.select("*", F.explode(F.array_repeat(F.lit(0), copies)).alias("__copy"))
    return delivered.selectExpr(*[f"{e} AS {c}" for c, e in EVENT_COLUMNS.items()])


def station_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_station_events(table(spark, sf_dir, "events"))


#: Micro-batches that a table is dealt to, and seconds by which its rows arrive late at most.
ARRIVALS, DELAY_S = 6, 900
#: Rows of one landed file, about; a span of many rows is landed as several files.
FILE_ROWS = 250_000


def arriving(df: DataFrame, ts: str, identity: str, late_s: Column | None = None) -> DataFrame:
    """``df`` as an unbounded source of several micro-batches, in order of arrival.

    Each row arrives up to 15 minutes after its time, by a hash of ``identity``, so copies may come in later
    batches and rows out of order; ``late_s`` adds seconds to that. Arrivals are cut in equal spans of time and landed span by span; the stream
    takes one landed span at a time. A span has as many files as the average one needs, all of them dealt by a hash, so
    there are no more micro-batches over a large table than over a small one, and no task holds a whole span.
    """
    spark = df.sparkSession
    delay = F.pmod(F.xxhash64(identity), F.lit(DELAY_S)) + (F.lit(0) if late_s is None else late_s)
    timed = df.withColumn("__arrival", F.unix_timestamp(F.col(ts).cast("timestamp")) + delay)
    first, last, rows = timed.agg(F.min("__arrival"), F.max("__arrival"), F.count("*")).first()
    files = max(1, round(rows / ARRIVALS / FILE_ROWS))
    path = scratch_path(spark, "arrivals")
    span = (last - first) // ARRIVALS + 1
    for k in range(ARRIVALS):
        part = timed.filter(F.expr(f"(__arrival - {first}) div {span} = {k}")).drop("__arrival")
        part.repartition(files, identity).write.mode("append").parquet(path)
    return read_event_stream(spark, path, df.schema, "parquet", {"maxFilesPerTrigger": str(files)})


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table, arriving in several batches."""
    return arriving(table(spark, sf_dir, "events"), "ts", "event_id")


#: Where station events come late, one in so many does, by up to one part in ``LATE_PARTS`` of the time the table spans.
LATE_EVERY, LATE_PARTS = 10, 3


def station_event_stream(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """Station events, arriving in several batches; copies of an event arrive at different times.

    A delay of minutes crosses from one batch to the next only where batches meet: about 200 rows, however large the
    table is. With ``late`` one row in ten, original or copy, comes later still by up to a third of the time that the
    table spans, so the share of rows that come one or two batches late is the same at any size.
    """
    events = station_events(spark, sf_dir)
    copy = F.concat_ws("|", "event_timestamp", F.monotonically_increasing_id())
    late_s = None
    if late:
        time = F.unix_timestamp(F.col("event_timestamp").cast("timestamp"))
        first, last = events.agg(F.min(time), F.max(time)).first()
        is_late = F.pmod(F.xxhash64("__copy", F.lit("late")), F.lit(LATE_EVERY)) == 0
        by = F.pmod(F.xxhash64("__copy", F.lit("by")), F.lit((last - first) // LATE_PARTS + 1))
        late_s = F.when(is_late, by).otherwise(0)
    return arriving(events.withColumn("__copy", copy), "event_timestamp", "__copy", late_s).drop("__copy")


def late_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table with every 50th row delivered twice, and originals and copies that come weeks late."""
    events = table(spark, sf_dir, "events")
    copies = F.when(F.col("event_id") % 50 == 0, 2).otherwise(1)
    delivered = events.select("*", F.posexplode(F.array_repeat(F.lit(0), copies)).alias("__copy", "__zero")).drop("__zero")
    # One original in 97 is a week late or more; of the copies one in three is late.
    late = F.col("event_id") % 97 == 0
    late |= (F.col("__copy") > 0) & (F.col("event_id") % 3 == 0)
    late_s = F.when(late, 86400 * (7 + F.col("event_id") % 14)).otherwise(0)
    identity = F.concat_ws("|", "event_id", "__copy")
    rows = delivered.withColumn("__id", identity).withColumn("__late", late_s)
    return arriving(rows, "ts", "__id", F.col("__late")).select(*events.columns)
