"""The six marts, as lazy DataFrames over the cleaned facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hundredths, mean_2dp, ratio_2dp
from ..operators import drop_anomaly, latest_per_key, share_of_total, stack_sides, with_previous

# A drop of at least this many bikes within this many seconds is abnormal.
ANOMALY_MAX_GAP_S = 60
ANOMALY_MIN_DROP = 50
ANOMALY_LABEL = "ANOMALY BIKE DROPS"
NORMAL_LABEL = "NORMAL"

HOURS_PER_DAY = 24


def _facet(name: str) -> Column:
    """True on the rows of a grouping set that groups by ``name``."""
    return F.col(f"by_{name}")


def _peak_hour(hour: str, n: str) -> Column:
    """Hour with the highest count among the rows of its facet; the smallest hour wins a tie.

    Count and hour are ranked as one number: unlike a struct it keeps the aggregation hash-based.
    """
    rank = F.col(n) * HOURS_PER_DAY - F.col(hour)
    return F.max_by(F.when(_facet(hour), F.col(hour)), F.when(_facet(hour), rank))


def daily_trip_summary(trips: DataFrame) -> DataFrame:
    """Per day: trips, mean duration, distinct start and end stations, busiest hour.

    One scan and one large aggregation serve all five figures: grouping sets count per (day, hour),
    (day, start station) and (day, end station) with map-side combining, and the second aggregation
    reads at most hours + 2 x stations rows per day. Trips without a date form one row without a peak.
    """
    facets = ["ride_hour", "start_station_id", "end_station_id"]
    cents = hundredths(F.col("ride_duration_minutes"))
    counted = trips.groupingSets([["trip_date", f] for f in facets], "trip_date", *facets).agg(
        F.count("*").alias("n"),
        F.sum(cents).alias("cents"),
        F.count("ride_duration_minutes").alias("timed"),
        *[(F.grouping(f) == 0).alias(f"by_{f}") for f in facets],
    )
    by_hour = _facet("ride_hour")

    def distinct(facet: str) -> Column:
        return F.count_if(_facet(facet) & F.col(facet).isNotNull())

    per_day = counted.groupBy("trip_date").agg(
        F.sum(F.when(by_hour, F.col("n"))).alias("total_trips"),
        mean_2dp(F.sum(F.when(by_hour, F.col("cents"))), F.sum(F.when(by_hour, F.col("timed")))).alias(
            "avg_ride_duration_minutes"
        ),
        distinct("start_station_id").alias("active_start_station_count"),
        distinct("end_station_id").alias("active_end_station_count"),
        _peak_hour("ride_hour", "n").alias("peak_hour"),
    )
    return per_day.withColumn("peak_hour", F.when(F.col("trip_date").isNotNull(), F.col("peak_hour")))


def station_activity(trips: DataFrame) -> DataFrame:
    """Each trip as a START row at one station and an END row at another, both on the trip's date."""
    return stack_sides(
        trips,
        {
            "START": {"station_id": F.col("start_station_id"), "activity_hour": F.hour("started_at")},
            "END": {"station_id": F.col("end_station_id"), "activity_hour": F.hour("ended_at")},
        },
        keep=["trip_date"],
        tag="activity_type",
    ).filter(F.col("station_id").isNotNull())


def station_facets(activity: DataFrame, starts: Column, n: Column) -> DataFrame:
    """Starts and activity per (station, hour) and per (station, day), in one aggregation with grouping sets."""
    facets = ["activity_hour", "trip_date"]
    return activity.groupingSets([["station_id", f] for f in facets], "station_id", *facets).agg(
        starts.alias("starts"), n.alias("n"), *[(F.grouping(f) == 0).alias(f"by_{f}") for f in facets]
    )


def station_summary(trips: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per station: starts, ends, activity per active day, busiest hour, and its mapped name.

    As in the daily mart, one aggregation with grouping sets feeds every figure. A station that the
    mapping lists twice appears twice.
    """
    starts = F.count_if(F.col("activity_type") == "START")
    return station_figures(station_facets(station_activity(trips), starts, F.count("*")), mapping)


def station_figures(counted: DataFrame, mapping: DataFrame) -> DataFrame:
    """The station mart from :func:`station_facets`."""
    by_hour = _facet("activity_hour")
    total = F.sum(F.when(by_hour, F.col("n")))
    starts = F.sum(F.when(by_hour, F.col("starts")))
    days = F.count_if(_facet("trip_date") & F.col("trip_date").isNotNull())
    per_station = counted.groupBy("station_id").agg(
        starts.alias("start_trip_count"),
        (total - starts).alias("end_trip_count"),
        total.alias("total_station_activity"),
        ratio_2dp(total, days).alias("avg_daily_activity"),
        _peak_hour("activity_hour", "n").alias("peak_hour"),
    )
    names = mapping.select(
        F.col("batch_station_id"),
        F.coalesce("batch_station_name", "stream_station_name").alias("station_name"),
    )
    return per_station.join(names, F.col("station_id") == F.col("batch_station_id"), "left").select(
        "station_id",
        "station_name",
        "start_trip_count",
        "end_trip_count",
        "total_station_activity",
        "avg_daily_activity",
        "peak_hour",
    )


def station_user_summary(trips: DataFrame) -> DataFrame:
    """Per start station and name: trips of each rider type, and their percentages."""
    counted = (
        trips.filter(F.col("start_station_id").isNotNull())
        .groupBy(
            F.col("start_station_id").alias("station_id"), F.col("start_station_name").alias("station_name")
        )
        .agg(
            F.count_if(F.col("member_casual") == "member").alias("member_trips"),
            F.count_if(F.col("member_casual") == "casual").alias("casual_trips"),
            F.count("*").alias("total_trips"),
        )
    )
    return rider_percentages(counted)


def rider_percentages(counted: DataFrame) -> DataFrame:
    """Adds the share of each rider type in ``total_trips``."""
    return counted.withColumns(
        {
            f"{kind}_percentage": ratio_2dp(F.col(f"{kind}_trips"), F.col("total_trips"), scale=100)
            for kind in ("member", "casual")
        }
    )


def user_type_summary(trips: DataFrame) -> DataFrame:
    """Per rider type: trips, share of all trips, mean duration.

    Cleaning admits two rider types, so the total is taken over two rows.
    """
    counted = (
        trips.filter(F.col("member_casual").isNotNull())
        .groupBy("member_casual")
        .agg(
            F.count("*").alias("total_trips"),
            F.sum(hundredths(F.col("ride_duration_minutes"))).alias("cents"),
            F.count("ride_duration_minutes").alias("timed"),
        )
    )
    return type_shares(counted)


def type_shares(counted: DataFrame) -> DataFrame:
    """The rider type mart from trips, hundredths of minutes and timed trips of each type."""
    return share_of_total(counted, "total_trips", "trip_percentage", few_groups=True).select(
        "member_casual",
        "total_trips",
        "trip_percentage",
        mean_2dp(F.col("cents"), F.col("timed")).alias("avg_ride_duration_minutes"),
    )


def latest_station_status(events: DataFrame) -> DataFrame:
    """Most recent event of every station."""
    return latest_per_key(events, ["station_id"], "event_timestamp")


#: What is compared with the predecessor at the station.
COMPARED = ("num_bikes_available", "num_docks_available", "event_timestamp")


def compare_events(
    events: DataFrame, slice_unit: str = "hour", before: DataFrame | None = None, laid_out: str | None = None
) -> DataFrame:
    """Add each event's predecessor at the station, the changes since, and the anomaly label.

    One ``slice_unit`` of one station is the unit of sorting. Timestamps are unique per station and
    carry milliseconds, so an hour is at most 3.6 million rows however many the station holds. Each
    unit costs one carried row; take a day for feeds that report less than a few times per hour.
    ``before``: see :func:`tripmart.operators.with_previous`. ``laid_out`` names the column of the slice in a table
    that is bucketed by station and slice: then no event is shuffled.
    """
    compared = with_previous(
        events,
        ["station_id"],
        ["event_timestamp"],
        COMPARED,
        slice_by=F.col(laid_out) if laid_out else F.date_trunc(slice_unit, "event_timestamp"),
        before=before,
        laid_out=laid_out is not None,
    )
    return drop_anomaly(
        compared,
        "num_bikes_available",
        "event_timestamp",
        max_gap_s=ANOMALY_MAX_GAP_S,
        min_drop=ANOMALY_MIN_DROP,
        anomaly_label=ANOMALY_LABEL,
        normal_label=NORMAL_LABEL,
        drop_name="bikes_difference",
    )


def monitoring_columns(compared: DataFrame) -> DataFrame:
    """The columns of the anomaly mart from the output of :func:`compare_events`."""
    return compared.select(
        "station_id",
        "station_name",
        "num_bikes_available",
        F.col("previous_num_bikes_available").alias("previous_bikes_available"),
        "bikes_difference",
        "num_docks_available",
        F.col("previous_num_docks_available").alias("previous_docks_available"),
        (F.col("previous_num_docks_available") - F.col("num_docks_available")).alias("docks_difference"),
        "time_diff_seconds",
        "anomaly_status",
        "event_timestamp",
    )


def station_anomaly(events: DataFrame, slice_unit: str = "hour", laid_out: str | None = None) -> DataFrame:
    """Every event next to its predecessor at the station, with abnormal bike drops marked."""
    return monitoring_columns(compare_events(events, slice_unit, laid_out=laid_out))
