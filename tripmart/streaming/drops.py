"""Abnormal drops over a stream: the streaming twin of the anomaly mart.

``lag`` follows event time, so a row can be compared only once no earlier row of its station can arrive
any more. Each micro-batch therefore releases the rows up to the frontier (greatest event time seen
minus the allowed lateness), compares them with the batch operator, and stores as state the last
released row of each station plus the rows still waiting. All of it is joins, windows and aggregates
over the micro-batch: unlike a keyed state function, a station that sends a third of all events is
spread over tasks by :func:`tripmart.operators.with_previous`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedupe_first, latest_per_key, total_order
from .sinks import append_batch, start_query

_RELEASED = "__released"
_KEYS = ["station_id", "event_timestamp"]

CHANGES, STATE, LATE = "changes", "state", "late"


def _slot(path: str, batch_id: int) -> str:
    # Two slots suffice: a re-run of a batch reads its predecessor's slot and replaces its own.
    return f"{path}/{STATE}/slot={batch_id % 2}"


def _frontier(rows: DataFrame, lateness_s: int) -> datetime | None:
    """Greatest event time minus the lateness: one value, computed by a map-side combined aggregate."""
    newest = rows.agg(F.max("event_timestamp")).first()[0]
    return newest and newest - timedelta(seconds=lateness_s)


def _up_to(frontier: datetime | None) -> Column:
    """True for the rows whose turn has come; without a frontier there is none."""
    if frontier is None:
        return F.lit(False)
    # As text: a datetime literal would pass through the time zone of the Python process.
    limit = F.lit(frontier.isoformat(" ")).cast("timestamp_ntz")
    return F.coalesce(F.col("event_timestamp") <= limit, F.lit(False))


def _step(
    batch: DataFrame, batch_id: int, path: str, compare: Callable[[DataFrame], DataFrame], lateness_s: int
) -> None:
    fresh = batch.withColumn(_RELEASED, F.lit(False)).persist()
    arrived = fresh
    if not batch_id:
        _refuse_old_results(batch.sparkSession, path)
        append_batch(batch.filter(F.lit(False)), f"{path}/{LATE}", batch_id)
    else:
        state = batch.sparkSession.read.schema(fresh.schema).parquet(_slot(path, batch_id - 1))
        is_late = _up_to(_frontier(state, lateness_s))
        append_batch(fresh.filter(is_late).drop(_RELEASED), f"{path}/{LATE}", batch_id)
        fresh = state.unionByName(fresh.filter(~is_late))

    # Released rows sort first, so a replay never replaces its original.
    order = total_order(fresh, [F.col(_RELEASED).desc()], skip=[*_KEYS, _RELEASED])
    rows = dedupe_first(fresh, _KEYS, order).persist()
    is_due = _up_to(_frontier(rows, lateness_s))
    due = rows.filter(is_due)
    append_batch(compare(due).filter(~F.col(_RELEASED)).drop(_RELEASED), f"{path}/{CHANGES}", batch_id)

    last = latest_per_key(due, ["station_id"], "event_timestamp", []).withColumn(_RELEASED, F.lit(True))
    last.unionByName(rows.filter(~is_due)).write.mode("overwrite").parquet(_slot(path, batch_id))
    rows.unpersist()
    arrived.unpersist()


def _refuse_old_results(spark: SparkSession, path: str) -> None:
    """A first batch among later ones means that the checkpoint of ``path`` is another one."""
    try:
        old = spark.read.parquet(f"{path}/{CHANGES}").filter("batch_id > 0").take(1)
    except AnalysisException:
        return
    if old:
        raise ValueError(f"{path} holds results of another run; use its checkpoint or a new path")


def detect_drops_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    compare: Callable[[DataFrame], DataFrame],
    lateness_s: int = 600,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each event with its predecessor to ``path/changes`` once its turn has come.

    ``compare`` adds the comparison columns and keeps all others, as in
    :func:`tripmart.plans.marts.compare_events`. Events that arrive after their place in the order was
    passed go to ``path/late``; :func:`read_drops` puts them in their place.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        _step(batch, batch_id, path, compare, lateness_s)

    return start_query(events, checkpoint, process, trigger or {"availableNow": True}, "append")


def read_drops(
    spark: SparkSession,
    path: str,
    compare: Callable[[DataFrame], DataFrame],
    last_batch: int | None = None,
) -> DataFrame:
    """The changes written so far, late events included. With ``last_batch`` the rows still waiting are compared
    and added, which for a stream that has ended gives exactly the batch answer, whatever the lateness.

    A late event changes its successor's comparison as well, so the stations that have one are compared again;
    all others are read as they were written.
    """
    done = spark.read.parquet(f"{path}/{CHANGES}").drop("batch_id")
    if last_batch is not None:
        state = spark.read.parquet(_slot(path, last_batch))
        done = done.unionByName(compare(state).filter(~F.col(_RELEASED)).drop(_RELEASED))
    late = spark.read.parquet(f"{path}/{LATE}").drop("batch_id")
    stations = late.select("station_id").distinct()
    placed = done.join(stations, "station_id", "left_semi").select(*late.columns).withColumn(_RELEASED, F.lit(True))
    every = placed.unionByName(late.withColumn(_RELEASED, F.lit(False)))
    # A late copy never replaces the row that was there first.
    order = total_order(every, [F.col(_RELEASED).desc()], skip=[*_KEYS, _RELEASED])
    again = compare(dedupe_first(every, _KEYS, order).drop(_RELEASED))
    return done.join(stations, "station_id", "left_anti").unionByName(again)
