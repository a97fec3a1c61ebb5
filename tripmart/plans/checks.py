"""Quality checks. Every check yields rows ``(check, subject, metric, value, passed)``."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class CheckFailed(Exception):
    """Raised by :func:`require` when a check did not pass."""


def _rows(df: DataFrame, check: str, subject: str, metrics: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``df`` has one row; each metric is a (value, passed) pair of columns of it."""
    entries = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(subject).alias("subject"),
            F.lit(metric).alias("metric"),
            value.cast("bigint").alias("value"),
            passed.alias("passed"),
        )
        for metric, (value, passed) in metrics.items()
    ]
    return df.select(F.inline(F.array(*entries)))


def expect_rows(df: DataFrame, subject: str, where: Column | None = None, minimum: int = 1) -> DataFrame:
    """At least ``minimum`` rows, optionally among those that satisfy ``where``."""
    counted = (df if where is None else df.filter(where)).agg(F.count("*").alias("n"))
    return _rows(counted, "rows", subject, {"count": (F.col("n"), F.col("n") >= minimum)})


def row_counts(tables: Mapping[str, DataFrame], minimum: int = 0) -> DataFrame:
    """Row count of each table."""
    return union(*[expect_rows(df, name, minimum=minimum) for name, df in tables.items()])


def find_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("total")).filter(F.col("total") > 1)


def expect_unique(df: DataFrame, subject: str, key: str) -> DataFrame:
    """No key occurs twice."""
    counted = find_duplicates(df, key).agg(F.count("*").alias("n"))
    return _rows(counted, "duplicates", subject, {key: (F.col("n"), F.col("n") == 0)})


def null_profile(df: DataFrame, subject: str, rules: Mapping[str, Column]) -> DataFrame:
    """Number of rows that break each rule, all counted in one pass."""
    counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    metrics = {name: (F.col(name), F.col(name) == 0) for name in rules}
    return _rows(counted, "invalid values", subject, metrics)


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def trip_rules() -> dict[str, Column]:
    """Rules that no cleaned trip may break."""
    return {
        "invalid_ride_id": is_blank("ride_id"),
        "invalid_started_at": F.col("started_at").isNull(),
        "invalid_ended_at": F.col("ended_at").isNull(),
        "invalid_start_station": is_blank("start_station_id"),
        "invalid_end_station": is_blank("end_station_id"),
    }


def observed_write(
    df: DataFrame, write: Callable[[DataFrame], None], subject: str, rules: Mapping[str, Column], minimum: int = 1
) -> DataFrame:
    """Write ``df`` and give :func:`row_counts` and :func:`null_profile` of exactly the rows that were written.

    The figures are collected by the job that writes (``observe``), so the rows are not read again, and can't have
    changed in between. A task that runs again after a lost executor counts once.
    """
    seen = Observation(subject)
    counts = [F.count_if(rule).alias(name) for name, rule in rules.items()]
    write(df.observe(seen, F.count(F.lit(1)).alias("count"), *counts))
    got = seen.get
    rows = [("rows", subject, "count", got["count"], got["count"] >= minimum)]
    rows += [("invalid values", subject, name, got[name], got[name] == 0) for name in rules]
    return df.sparkSession.createDataFrame(rows, "check string, subject string, metric string, value long, passed boolean")


def union(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require(checks: DataFrame) -> None:
    """Run the checks and fail if one did not pass. There is one row per check, so this collects few."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.check} {r.subject}.{r.metric} = {r.value}" for r in failed))
