"""Marts kept up to date by loads: sums that can be added up, by day, and marts made from those sums.

Two small tables hold all that the four trip marts need: activity by (day, station, hour), and riders by (day, start
station, rider type). A load adds its own sums to those of the days that it touches; other days are neither read nor
written. Marts aggregate the sums, which number days times stations times hours, not trips.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hundredths, mean_2dp
from ..sources.schemas import columns
from ..sources.versions import PART, VERSION, Commit, commit, day_part, last_commit, read_parts, write_parts
from . import marts

ACTIVITY, RIDERS = "activity", "riders"

_SCHEMAS = {
    ACTIVITY: columns("trip_date date, station_id string, activity_hour integer, starts long, n long"),
    RIDERS: columns(
        "trip_date date, station_id string, station_name string, member_casual string, n long, cents long, timed long"
    ),
}
_KEYS = {ACTIVITY: 3, RIDERS: 4}


def _sums(kind: str, rows: DataFrame) -> DataFrame:
    names = _SCHEMAS[kind].names
    keys, values = names[: _KEYS[kind]], names[_KEYS[kind] :]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def activity_sums(trips: DataFrame) -> DataFrame:
    sides = marts.station_activity(trips)
    starts = F.when(F.col("activity_type") == "START", 1).otherwise(0).cast("long")
    return _sums(ACTIVITY, sides.withColumns({"starts": starts, "n": F.lit(1).cast("long")}))


def rider_sums(trips: DataFrame) -> DataFrame:
    rows = trips.select(
        "trip_date",
        F.col("start_station_id").alias("station_id"),
        F.col("start_station_name").alias("station_name"),
        "member_casual",
        F.lit(1).cast("long").alias("n"),
        hundredths(F.col("ride_duration_minutes")).alias("cents"),
        F.col("ride_duration_minutes").isNotNull().cast("long").alias("timed"),
    )
    return _sums(RIDERS, rows)


def refresh(spark: SparkSession, path: str, trips: DataFrame, load: str, unit: str = "day") -> list[str]:
    """Add the trips of a load, none of which another load holds, to the sums at ``path``; the days that it touched.

    With ``unit`` ``month`` sums are stored by month, for sparse data; all loads of a path must name the same.

    ``load`` names the load. One that is in already is not added again, so a run that died after its commit can
    simply be repeated; one that died before it left nothing behind that counts.
    """
    old = last_commit(spark, path)
    done = json.loads(old.note)["loads"] if old.note else []
    if load in done:
        return []
    number = old.number + 1
    parts = dict(old.parts)
    rows = trips.select(
        "trip_date", "start_station_id", "start_station_name", "end_station_id", "started_at", "ended_at",
        "member_casual", "ride_duration_minutes",
    ).persist()
    touched: set[str] = set()
    for kind, sums in ((ACTIVITY, activity_sums(rows)), (RIDERS, rider_sums(rows))):
        added = sums.withColumn(PART, day_part("trip_date", unit)).persist()
        days = [r[0] for r in added.select(PART).distinct().collect()]
        before = read_parts(spark, path, kind, _SCHEMAS[kind], old, days).drop(VERSION)
        whole = _sums(kind, added.unionByName(before)).withColumn(PART, day_part("trip_date", unit))
        for p in write_parts(whole, path, kind, number):
            parts[kind, p] = (number,)
        touched.update(days)
        added.unpersist()
    rows.unpersist()
    commit(spark, path, Commit(number, parts, json.dumps({"loads": [*done, load]})))
    return sorted(touched)


def read_sums(spark: SparkSession, path: str, kind: str, days: list[str] | None = None) -> DataFrame:
    """``activity`` or ``riders`` as of the last load."""
    return read_parts(spark, path, kind, _SCHEMAS[kind], last_commit(spark, path), days).drop(PART, VERSION)


def daily_trip_summary(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`tripmart.plans.marts.daily_trip_summary`."""
    facets = ["activity_hour", "station_id"]
    starts = F.sum("starts")
    counted = (
        read_sums(spark, path, ACTIVITY)
        .groupingSets([["trip_date", f] for f in facets], "trip_date", *facets)
        .agg(
            starts.alias("starts"),
            (F.sum("n") - starts).alias("ends"),
            *[(F.grouping(f) == 0).alias(f"by_{f}") for f in facets],
        )
    )
    hour = F.col("by_activity_hour") & (F.col("starts") > 0)
    rank = F.col("starts") * marts.HOURS_PER_DAY - F.col("activity_hour")
    places = counted.groupBy("trip_date").agg(
        F.max_by(F.when(hour, F.col("activity_hour")), F.when(hour, rank)).alias("peak_hour"),
        *[
            F.count_if(F.col("by_station_id") & (F.col(f"{side}s") > 0)).alias(f"active_{side}_station_count")
            for side in ("start", "end")
        ],
    )
    totals = read_sums(spark, path, RIDERS).groupBy("trip_date").agg(
        F.sum("n").alias("total_trips"),
        mean_2dp(F.sum("cents"), F.sum("timed")).alias("avg_ride_duration_minutes"),
    )
    same = totals.trip_date.eqNullSafe(places.trip_date)
    return totals.join(places, same).select(
        totals.trip_date,
        "total_trips",
        "avg_ride_duration_minutes",
        "active_start_station_count",
        "active_end_station_count",
        F.when(totals.trip_date.isNotNull(), F.col("peak_hour")).alias("peak_hour"),
    )


def station_summary(spark: SparkSession, path: str, mapping: DataFrame) -> DataFrame:
    """As :func:`tripmart.plans.marts.station_summary`."""
    return marts.station_figures(marts.station_facets(read_sums(spark, path, ACTIVITY), F.sum("starts"), F.sum("n")), mapping)


def station_user_summary(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`tripmart.plans.marts.station_user_summary`."""
    riders = read_sums(spark, path, RIDERS).filter(F.col("station_id").isNotNull())
    counted = riders.groupBy("station_id", "station_name").agg(
        *[
            F.sum(F.when(F.col("member_casual") == kind, F.col("n")).otherwise(0)).alias(f"{kind}_trips")
            for kind in ("member", "casual")
        ],
        F.sum("n").alias("total_trips"),
    )
    return marts.rider_percentages(counted)


def user_type_summary(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`tripmart.plans.marts.user_type_summary`."""
    riders = read_sums(spark, path, RIDERS).filter(F.col("member_casual").isNotNull())
    counted = riders.groupBy("member_casual").agg(
        F.sum("n").alias("total_trips"), F.sum("cents").alias("cents"), F.sum("timed").alias("timed")
    )
    return marts.type_shares(counted)
