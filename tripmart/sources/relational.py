"""Time-range extracts, from a DataFrame or over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def extract_range(
    df: DataFrame, start: str, end: str, column: str = "started_at", ordered: bool = False
) -> DataFrame:
    """Rows with ``start <= column < end``. Ask for the order only if the consumer needs it: it is a
    full range-partitioned sort."""
    ts = F.col(column)
    out = df.filter((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))
    return out.orderBy(column) if ordered else out


def trip_dates(
    df: DataFrame, start: str, end: str, column: str = "started_at", name: str = "trip_date"
) -> DataFrame:
    """Distinct days with data in ``[start, end)``, in order."""
    days = extract_range(df, start, end, column).select(F.to_date(column).alias(name))
    return days.distinct().orderBy(name)


def day_predicates(start: date, end: date, column: str = "started_at") -> list[str]:
    """One half-open predicate per day of ``[start, end)``: the partitions of a parallel JDBC scan."""
    days = (start + timedelta(days=i) for i in range((end - start).days))
    return [
        f"{column} >= TIMESTAMP '{d} 00:00:00' AND {column} < TIMESTAMP '{d + timedelta(days=1)} 00:00:00'"
        for d in days
    ]


def read_trips_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    start: date,
    end: date,
    properties: Mapping[str, str] | None = None,
    column: str = "started_at",
) -> DataFrame:
    """Extract a range from a relational source with one task per day; the source's index on ``column``
    serves each predicate, and column selections are pushed into the query."""
    return spark.read.jdbc(
        url,
        table,
        predicates=day_predicates(start, end, column),
        properties={"preferTimestampNTZ": "true", "fetchsize": "10000", **(properties or {})},
    )
