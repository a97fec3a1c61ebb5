"""The dashboard questions, answered from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import top_k
from .marts import ANOMALY_LABEL


def monthly_trend(daily: DataFrame) -> DataFrame:
    """Trips per calendar month."""
    month = F.to_date(F.trunc("trip_date", "month")).alias("trip_month")
    return daily.groupBy(month).agg(F.sum("total_trips").alias("total_trips"))


def top_stations(stations: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` stations with the most activity."""
    return top_k(stations, "total_station_activity", ["station_id"], k)


def bikes_available(latest: DataFrame) -> DataFrame:
    """Bikes available now, over all stations."""
    return latest.agg(F.sum("num_bikes_available").alias("bikes_available"))


def active_stations(latest: DataFrame) -> DataFrame:
    """Stations that are installed, renting and returning in their latest status."""
    active = F.col("is_installed") & F.col("is_renting") & F.col("is_returning")
    return latest.agg(F.count_if(active).alias("active_stations"))


def anomalies_by_station(monitoring: DataFrame) -> DataFrame:
    """Abnormal drops per station."""
    hits = monitoring.filter(F.col("anomaly_status") == ANOMALY_LABEL)
    return hits.groupBy("station_id").agg(F.count("*").alias("anomalies"))
