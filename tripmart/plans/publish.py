"""Write, audit, publish: a layer of tables whose readers only ever see a version that passed its checks.

Tables are written beside the published ones, audited as they lie there, and put in place by one commit, all of them
together. A failing check, or a run that dies anywhere before the commit, leaves the published version as it is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import register_views
from ..sources.versions import PART, VERSION, Commit, commit, day_part, last_commit, read_parts, write_parts
from ..streaming.validate import split_valid_invalid
from . import checks
from .events import clean_events
from .medallion import Silver, gold, silver_checks
from .stations import batch_station_reference, station_mapping, stream_station_reference
from .trips import clean_trips

AUDITS = "audits"
_WHOLE = "all"


@dataclass(frozen=True)
class Draft:
    """A table to publish: rows, the time column by whose day it is laid out (if any), and the order within files.

    ``unit`` is ``day``, or ``month`` where a day holds too little for a file of its own.
    """

    rows: DataFrame
    by_day: str | None = None
    cluster: Sequence[str] = ()
    unit: str = "day"


def publish(
    spark: SparkSession,
    path: str,
    drafts: Mapping[str, Draft],
    audit: Callable[[Mapping[str, DataFrame]], DataFrame],
    gate: bool = True,
) -> int:
    """Write all drafts as the next version of the layer at ``path``, audit what was written, and publish it.

    ``audit`` gets the written tables by name and gives rows of checks, which are kept below ``path/audits``. With
    ``gate`` a failed one raises :class:`tripmart.plans.checks.CheckFailed` and nothing is published. Returns the
    number of the version.
    """
    old = last_commit(spark, path)
    number = old.number + 1
    parts: dict[tuple[str, str], tuple[int, ...]] = {}
    schemas = {name: draft.rows.schema for name, draft in drafts.items()}
    for name, draft in drafts.items():
        part = day_part(draft.by_day, draft.unit) if draft.by_day else F.lit(_WHOLE)
        for p in write_parts(draft.rows.withColumn(PART, part), path, name, number, draft.cluster):
            parts[name, p] = (number,)
    new = Commit(number, parts, json.dumps({name: json.loads(s.json()) for name, s in schemas.items()}))
    written = {name: _table(spark, path, name, new) for name in drafts}
    results = audit(written).select(F.lit(number).alias("number"), "*")
    results.write.mode("overwrite").parquet(f"{path}/{AUDITS}/{VERSION}={number}")
    if gate:
        checks.require(spark.read.schema(results.schema).parquet(f"{path}/{AUDITS}/{VERSION}={number}"))
    commit(spark, path, new)
    return number


def _table(spark: SparkSession, path: str, name: str, at: Commit) -> DataFrame:
    schemas = json.loads(at.note or "{}")
    if name not in schemas:
        raise ValueError(f"no published table {name} in {path}")
    schema = T.StructType.fromJson(schemas[name])
    return read_parts(spark, path, name, schema, at).drop(PART, VERSION)


def published(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the last published version."""
    return _table(spark, path, name, last_commit(spark, path))


def audits(spark: SparkSession, path: str) -> DataFrame:
    """Checks of all versions, also of the last one that failed, with the ``number`` of each."""
    try:
        return spark.read.parquet(f"{path}/{AUDITS}").drop(VERSION)
    except AnalysisException as e:
        raise ValueError(f"nothing was ever audited in {path}") from e


TRIPS, EVENTS, MAPPING = "fact_trips_cleaned", "fact_valid_events_cleaned", "dim_station_mapping"


def publish_silver(
    spark: SparkSession,
    path: str,
    staging_trips: DataFrame,
    staging_events: DataFrame,
    gate: bool = True,
    unit: str = "day",
) -> Silver:
    """Both facts and the station mapping as one version of the silver layer, and the views of the marts over it.

    The facts are laid out by ``unit`` (``day`` or ``month``). The audit is that of the silver layer and, as the marts are
    views over it, the row counts of the marts that the new version would give. If a check fails, :func:`published_silver` still gives the version before.
    """
    valid, _ = split_valid_invalid(staging_events)
    mapping = station_mapping(batch_station_reference(staging_trips), stream_station_reference(valid))
    drafts = {
        TRIPS: Draft(clean_trips(staging_trips), "trip_date", ["member_casual", "start_station_id"], unit),
        EVENTS: Draft(clean_events(staging_events), "event_timestamp", ["station_id"], unit),
        MAPPING: Draft(mapping),
    }

    def audit(tables: Mapping[str, DataFrame]) -> DataFrame:
        silver = Silver(tables[TRIPS], tables[EVENTS], tables[MAPPING])
        return checks.union(silver_checks(silver), checks.row_counts(gold(silver), minimum=1))

    publish(spark, path, drafts, audit, gate)
    silver = published_silver(spark, path)
    register_views(gold(silver))
    return silver


def published_silver(spark: SparkSession, path: str) -> Silver:
    return Silver(*[published(spark, path, name) for name in (TRIPS, EVENTS, MAPPING)])
