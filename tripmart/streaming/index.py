"""Stream de-duplication that asks an index of the stored keys before it reads any of them.

The index holds, for each event day, a Bloom filter in buckets: a key's hash names a bucket of the day and a few bits
in it. Filters are bitmaps made and merged by Spark's bitmap aggregates. A message of which a bit is not set is new
for sure; only days for which some message may be a copy have their keys read, and only those messages are compared.
An ordinary stream, whose copies come soon after their originals, reads next to nothing that is stored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedupe_first, total_order
from ..sources.versions import (
    PART,
    VERSION,
    Commit,
    commit,
    day_part,
    last_commit,
    read_parts,
    require_same_run,
    write_parts,
)
from .sinks import append_batch, start_query

EVENTS, INDEX, JOURNAL = "events", "index", "journal"

#: Bits of one bitmap of Spark's bitmap functions.
_BITMAP_BITS = 32768
_HASH, _BUCKET, _BITMAP = "__hash", "__bucket", "__bitmap"

_INDEX = T.StructType([T.StructField(_BUCKET, T.LongType()), T.StructField(_BITMAP, T.BinaryType())])
_JOURNAL = "messages long, new_by_index long, asked long, stored long, days string, days_read string"


def _positions(bits: int) -> list[Column]:
    """Places of a key's bits in its bucket; the bucket takes the low bits of the hash, each place 15 higher ones."""
    return [F.shiftright(_HASH, 19 + 15 * k).bitwiseAND(F.lit(_BITMAP_BITS - 1)) for k in range(bits)]


def _is_set(position: Column) -> Column:
    byte = F.substring(_BITMAP, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (position % 8).cast("int")) == 1


def index_of(keyed: DataFrame, bits: int) -> DataFrame:
    """``part``, bucket and bitmap of rows that have a part, a hash and a bucket."""
    marked = keyed.select(PART, _BUCKET, F.explode(F.array(*_positions(bits))).alias("__bit"))
    return marked.groupBy(PART, _BUCKET).agg(F.bitmap_construct_agg("__bit").alias(_BITMAP))


def may_be_stored(keyed: DataFrame, index: DataFrame, bits: int) -> DataFrame:
    """Rows with ``__maybe``: whether the index of their part has all their bits."""
    found = keyed.join(index.select(PART, _BUCKET, _BITMAP), [PART, _BUCKET], "left")
    maybe = reduce(and_, [_is_set(p) for p in _positions(bits)])
    return found.withColumn("__maybe", F.coalesce(maybe, F.lit(False))).drop(_BITMAP)


def dedupe_stream_indexed(
    events: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    ts: str = "event_timestamp",
    trigger: dict | None = None,
    buckets: int = 256,
    bits: int = 3,
    merge_at: int = 24,
) -> StreamingQuery:
    """Append each message to ``path`` once, however late it or its copies arrive.

    The answer is that of :func:`tripmart.streaming.dedupe_stream`: ``keys`` must hold ``ts``, a key with NULLs equals
    itself, nothing is dropped for being late. What a micro-batch reads is the index of the days that it touches
    (4 KB for each of ``buckets`` a day, at most) and the keys of the days for which the index can't tell. A day of
    ``merge_at`` versions is rewritten as one by the batch that touches it next. ``path/journal`` tells, for each batch,
    how many messages the index settled and which days were read. At ``buckets`` 256 and three bits the index settles
    all but one in 100 of the new messages of a day of 700,000 keys.
    """
    if ts not in keys:
        raise ValueError(f"keys must hold {ts}")

    def process(batch: DataFrame, batch_id: int) -> None:
        _step(batch, batch_id, list(keys), path, ts, buckets, bits, merge_at)

    return start_query(events, checkpoint, process, trigger or {"availableNow": True}, "append")


def _step(
    batch: DataFrame, batch_id: int, keys: list[str], path: str, ts: str, buckets: int, bits: int, merge_at: int
) -> None:
    spark = batch.sparkSession
    old = last_commit(spark, path, before=batch_id)
    require_same_run(spark, path, old, batch_id)
    once = dedupe_first(batch, keys, total_order(batch, [], skip=keys))
    keyed = once.withColumn(PART, day_part(ts)).withColumn(_HASH, F.xxhash64(*keys))
    rows = keyed.withColumn(_BUCKET, F.pmod(_HASH, F.lit(buckets)).cast("long")).persist()
    counts = {r[0]: r[1] for r in rows.groupBy(PART).count().collect()}

    known = sorted(d for d in counts if (INDEX, d) in old.parts)
    index = read_parts(spark, path, INDEX, _INDEX, old, known)
    marked = may_be_stored(rows, index, bits).persist()
    asked = {r[0]: r[1] for r in marked.where("__maybe").groupBy(PART).count().collect()}
    new = marked.where("NOT __maybe")
    if asked:
        stored = read_parts(spark, path, EVENTS, batch.schema, old, sorted(asked))
        stored = stored.select(*[F.col(k).alias(f"__{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        new = new.unionByName(marked.where("__maybe").join(stored, reduce(and_, same), "left_anti"))
    new = new.select(*batch.columns, PART)

    # A day of many versions is written anew, its old rows with those of this batch.
    merged = [d for d in counts if len(old.parts.get((EVENTS, d), ())) >= merge_at]
    again = read_parts(spark, path, EVENTS, batch.schema, old, merged).select(*new.columns)
    days = write_parts(new.unionByName(again) if merged else new, path, EVENTS, batch_id)
    parts = dict(old.parts)
    for d in days:
        parts[EVENTS, d] = (batch_id,) if d in merged else (*parts.get((EVENTS, d), ()), batch_id)

    here = Commit(batch_id, {(EVENTS, d): (batch_id,) for d in days})
    written = read_parts(spark, path, EVENTS, batch.schema, here).withColumn(_HASH, F.xxhash64(*keys))
    fresh = index_of(written.withColumn(_BUCKET, F.pmod(_HASH, F.lit(buckets)).cast("long")), bits)
    before = read_parts(spark, path, INDEX, _INDEX, old, days).select(*fresh.columns)
    whole = fresh.unionByName(before).groupBy(PART, _BUCKET).agg(F.bitmap_or_agg(_BITMAP).alias(_BITMAP))
    for d in write_parts(whole, path, INDEX, batch_id):
        parts[INDEX, d] = (batch_id,)

    maybe = sum(asked.values())
    n_stored = written.count() - (again.count() if merged else 0)
    line = (sum(counts.values()), sum(counts.values()) - maybe, maybe, n_stored, json.dumps(sorted(counts)), json.dumps(sorted(asked)))
    append_batch(spark.createDataFrame([line], _JOURNAL), f"{path}/{JOURNAL}", batch_id)
    commit(spark, path, Commit(batch_id, parts))
    marked.unpersist()
    rows.unpersist()


def read_deduped_indexed(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str] | None = None
) -> DataFrame:
    """The messages that :func:`dedupe_stream_indexed` has stored, of all days or of those named (yyyy-MM-dd)."""
    return read_parts(spark, path, EVENTS, schema, last_commit(spark, path), days).drop(PART, VERSION)
