"""Streaming de-duplication and live latest status."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from ..operators import dedupe_first, total_order
from ..sources.versions import Commit, commit, last_commit
from .sinks import BATCH, start_query

_DAY = "event_day"


def dedupe_stream(
    events: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    ts: str = "event_timestamp",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append each message to ``path`` once, however late it or its copies arrive.

    A micro-batch keeps one row per key and adds those whose key is not stored yet. ``keys`` must hold ``ts``:
    stored rows lie in folders by batch and event day, and only days that the batch touches are read, their key
    columns alone. Nothing is dropped for being late, and no state grows with the stream. A key with NULLs
    equals itself. A batch that runs again replaces its own folder.
    """
    if ts not in keys:
        raise ValueError(f"keys must hold {ts}")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = dedupe_first(batch, keys, total_order(batch, [], skip=keys)).withColumn(_DAY, F.to_date(ts))
        rows = rows.persist()
        if batch_id:
            # The days of a batch are few. As literals they leave the folders of all others unread.
            days = [r[0] for r in rows.select(_DAY).distinct().collect()]
            touched = F.col(_DAY).isin([d for d in days if d is not None])
            if None in days:
                touched = touched | F.col(_DAY).isNull()
            stored = spark.read.schema(rows.withColumn(BATCH, F.lit(0)).schema).parquet(path)
            stored = stored.where(F.col(BATCH) < batch_id).where(touched).select(*keys)
            known = stored.select(*[F.col(k).alias(f"__{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
            new = rows.join(known, reduce(and_, same), "left_anti")
        else:
            new = rows
        # Gathered by day: else each task writes a file of its own for every day of the batch.
        new.hint("rebalance", _DAY).write.mode("overwrite").partitionBy(_DAY).parquet(f"{path}/{BATCH}={batch_id}")
        rows.unpersist()

    return start_query(events, checkpoint, process, trigger or {"availableNow": True}, "append")


def read_deduped(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The messages that :func:`dedupe_stream` has stored; ``schema`` is that of its events."""
    partitions = StructType([StructField(BATCH, IntegerType()), StructField(_DAY, DateType())])
    return spark.read.schema(StructType([*schema.fields, *partitions.fields])).parquet(path).drop(BATCH, _DAY)


def latest_status_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "station_id",
    ts: str = "event_timestamp",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the most recent event of every station in a table that each micro-batch replaces.

    The aggregate combines on the map side, so a micro-batch sends one row per station and task; the
    state holds one row per station. Equal timestamps are settled by the greater remaining columns, as by
    :func:`tripmart.operators.latest_per_key`. The table is one part of a versioned table
    (:mod:`tripmart.sources.versions`) in two slots, and the number of the batch is committed when its slot is
    whole: :func:`read_latest` finds the last finished one by itself.
    """
    rest = [c for c in events.columns if c not in (key, ts)]
    latest = events.groupBy(key).agg(F.max(F.struct(ts, *rest)).alias("__last"))
    columns = [F.col(key) if c == key else F.col(f"__last.{c}") for c in events.columns]
    table = latest.select(*columns)

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{current_slot(batch_id)}")
        commit(batch.sparkSession, path, Commit(batch_id))

    return start_query(table, checkpoint, process, trigger or {"availableNow": True}, "complete")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The table of the last finished micro-batch of :func:`latest_status_stream`."""
    number = last_commit(spark, path).number
    if number < 0:
        raise ValueError(f"no finished batch in {path}")
    return spark.read.parquet(f"{path}/{current_slot(number)}")


def current_slot(batch_id: int) -> str:
    return f"slot={batch_id % 2}"
