"""Valid and quarantined events as one table that stays readable over months: batches are merged into days.

A micro-batch is a part of its own at first, written with one cheap job. Every so many batches the writer merges what
is pending into parts by event day, and a day of many versions into one. Batch, merge and the list of what counts
are one commit: readers see every row once, also while a merge runs or after it died half-way, and open only the
folders that count, however many batches there have been.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources import versions
from ..sources.schemas import INVALID_EVENT, STATION_EVENT
from ..sources.versions import PART, VERSION, Commit, day_part, last_commit, read_parts, require_same_run, write_parts
from .sinks import start_query
from .validate import split_validated, validate_events

VALID, INVALID = "valid", "invalid"
SCHEMAS: dict[str, T.StructType] = {VALID: STATION_EVENT, INVALID: INVALID_EVENT}
_TS = "event_timestamp"


def _days(kind: str) -> str:
    """Kind of the merged rows."""
    return f"{kind}_days"


def write_split_log(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    compact_every: int = 60,
    merge_at: int = 24,
) -> StreamingQuery:
    """Validate a stream of events and keep valid and quarantined rows in ``path``.

    Every ``compact_every`` micro-batches those that are pending are merged into days, by event time; a day that
    has ``merge_at`` versions by then is written anew as one. A micro-batch that runs again, whatever of it was
    written before, gives the same table.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        append_split(batch, path, batch_id, compact_every, merge_at)

    return start_query(events, checkpoint, process, trigger or {"availableNow": True}, "append")


def append_split(batch: DataFrame, path: str, batch_id: int, compact_every: int, merge_at: int) -> None:
    """One micro-batch of :func:`write_split_log`."""
    spark = batch.sparkSession
    old = last_commit(spark, path, before=batch_id)
    require_same_run(spark, path, old, batch_id)
    checked = validate_events(batch).persist()
    parts = dict(old.parts)
    for kind, rows in zip((VALID, INVALID), split_validated(checked), strict=True):
        for p in write_parts(rows.withColumn(PART, F.lit(f"batch-{batch_id:012d}")), path, kind, batch_id):
            parts[kind, p] = (batch_id,)
    checked.unpersist()
    if (batch_id + 1) % compact_every == 0:
        for kind in (VALID, INVALID):
            parts = _merged(spark, path, kind, Commit(batch_id, parts), merge_at)
    # Through the module, so that a test can let it fail.
    versions.commit(spark, path, Commit(batch_id, parts))


def _merged(spark: SparkSession, path: str, kind: str, at: Commit, merge_at: int) -> dict:
    """The parts of a commit with the pending batches of a kind merged into days."""
    pending = at.names(kind)
    rows = read_parts(spark, path, kind, SCHEMAS[kind], at).drop(PART, VERSION).withColumn(PART, day_part(_TS))
    touched = [r[0] for r in rows.select(PART).distinct().collect()]
    full = [d for d in touched if len(at.parts.get((_days(kind), d), ())) >= merge_at]
    if full:
        rows = rows.unionByName(read_parts(spark, path, _days(kind), SCHEMAS[kind], at, full).drop(VERSION))
    parts = {k: v for k, v in at.parts.items() if k not in {(kind, p) for p in pending}}
    for d in write_parts(rows, path, _days(kind), at.number, ["station_id"]):
        before = () if d in full else at.parts.get((_days(kind), d), ())
        parts[_days(kind), d] = (*before, at.number)
    return parts


def read_split(spark: SparkSession, path: str, kind: str = VALID, days: list[str] | None = None) -> DataFrame:
    """Rows of a kind as of the last finished micro-batch, or those of some event days (yyyy-MM-dd)."""
    at = last_commit(spark, path)
    schema = SCHEMAS[kind]
    pending = read_parts(spark, path, kind, schema, at)
    if days is not None:
        pending = pending.where(day_part(_TS).isin(days))
    merged = read_parts(spark, path, _days(kind), schema, at, days)
    return merged.unionByName(pending).drop(PART, VERSION)
