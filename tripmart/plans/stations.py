"""Station dimensions and the mapping between the batch and the stream side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fold, safe_double
from ..operators import full_outer_on, latest_per_key, stack_sides

# Labels for a station that exists on one side only.
NO_BATCH = "NO MATCH BATCH"
NO_STREAM = "NO STREAM MATCH"


def batch_station_reference(staging: DataFrame) -> DataFrame:
    """Every station id seen at either end of a trip, with a name and its mean position.

    Ids are taken as stored: ``'S1'`` and ``'S1 '`` are two stations and ``''`` is one. Of several names
    the smallest is kept. Counting per (id, name) first keeps the large aggregation hash-based; the
    second one only sees one row per pair.
    """
    sides = {
        side: {
            "id": F.col(f"{side}_station_id"),
            "name": F.col(f"{side}_station_name"),
            "lat": F.col(f"{side}_lat"),
            "lon": F.col(f"{side}_lng"),
        }
        for side in ("start", "end")
    }
    # The casts come after the stacking, where the columns are plain references.
    per_name = (
        stack_sides(staging, sides)
        .filter(F.col("id").isNotNull() & F.col("name").isNotNull())
        .withColumns({c: safe_double(F.col(c)) for c in ("lat", "lon")})
        .groupBy("id", "name")
        .agg(
            *[F.sum(c).alias(f"{c}_sum") for c in ("lat", "lon")],
            *[F.count(c).alias(f"{c}_n") for c in ("lat", "lon")],
        )
    )
    return per_name.groupBy(F.col("id").alias("batch_station_id")).agg(
        F.min("name").alias("batch_station_name"),
        *[
            F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n").cast("double")).alias(f"batch_{c}")
            for c in ("lat", "lon")
        ],
    )


def stream_station_reference(events: DataFrame) -> DataFrame:
    """Latest description of every station id in the event stream."""
    named = events.filter(F.col("station_id").isNotNull() & F.col("station_name").isNotNull()).select(
        F.col("station_id").alias("stream_station_id"),
        F.col("station_name").alias("stream_station_name"),
        F.col("lat").try_cast("double").alias("stream_lat"),
        F.col("lon").try_cast("double").alias("stream_lon"),
        F.col("capacity").try_cast("bigint").alias("capacity"),
        "event_timestamp",
    )
    return latest_per_key(named, ["stream_station_id"], "event_timestamp").drop("event_timestamp")


def station_mapping(batch: DataFrame, stream: DataFrame, strict: bool = False) -> DataFrame:
    """Batch and stream stations matched by folded name; a missing side is labelled.

    A name shared by several stations of one side matches each of them, and so does a blank name: b blank batch
    and s blank stream names give b * s rows. With ``strict`` a blank name matches nothing.

    ``stream`` should come from valid events only, or a quarantined event may describe a station.
    """

    def key(name: str) -> Column:
        folded = fold(F.col(name))
        return F.nullif(folded, F.lit("")) if strict else folded

    joined = full_outer_on(batch, stream.drop("capacity"), key("batch_station_name"), key("stream_station_name"))
    labels = {
        "batch_station_id": NO_BATCH,
        "batch_station_name": NO_BATCH,
        "stream_station_id": NO_STREAM,
        "stream_station_name": NO_STREAM,
    }
    return joined.select(
        *[F.coalesce(F.col(c), F.lit(label)).alias(c) for c, label in labels.items()],
        "batch_lat",
        "batch_lon",
        "stream_lat",
        "stream_lon",
    )
