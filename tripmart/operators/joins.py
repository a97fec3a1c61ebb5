"""Joins. No broadcast hints: the size of a side decides, at planning time or through AQE, and a side
that is too large to broadcast falls back to a shuffled join whose hot partitions AQE can split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pick import dedupe_first, total_order


def new_rows(
    existing: DataFrame, incoming: DataFrame, key: str, arrival: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``incoming`` whose key is not stored yet, one per key; first arrival wins.

    ``arrival`` names the columns of ``incoming`` that give the order of arrival; they are dropped from
    the result. Any remaining tie is settled by content. A NULL key is an error, as for a primary key.
    Only the key column of ``existing`` is read.
    """
    keyed = incoming.withColumn(key, _required(key))
    order = total_order(
        keyed, [F.col(c).asc_nulls_first() for c in arrival], skip=[key, *arrival]
    )
    first = dedupe_first(keyed, [key], order).drop(*arrival)
    # The window left the rows hash-partitioned by the key, so this join does not shuffle them again.
    return first.join(existing.select(key), key, "left_anti").select(*existing.columns)


def _required(key: str) -> Column:
    return F.coalesce(F.col(key), F.raise_error(F.lit(f"NULL in key column {key}")))


def new_keys(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The keys of :func:`new_rows`, with copies: only the key column of either side is read and shuffled."""
    return incoming.select(_required(key).alias(key)).join(existing.select(key), key, "left_anti")


def append_new(
    existing: DataFrame, incoming: DataFrame, key: str, arrival: Sequence[str] = ()
) -> DataFrame:
    """``existing`` plus its :func:`new_rows`."""
    return existing.unionByName(new_rows(existing, incoming, key, arrival))


def full_outer_on(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    split: bool = False,
) -> DataFrame:
    """Full outer equi-join on two expressions; NULL keys match nothing.

    A key that b left and s right rows share gives b * s rows; see ``strict`` of
    :func:`tripmart.plans.stations.station_mapping` where that is not wanted.

    With ``split`` it is written as a left join plus the unmatched right rows, which computes both sides twice.
    A native full outer join can neither broadcast a small side nor have a hot key split by AQE; these two
    joins can, so it pays where one side is small or a key is hot.
    """
    k = "__join_key"
    rk = "__right_key"
    l_keyed = left.withColumn(k, left_key)
    r_keyed = right.withColumn(rk, right_key)
    if not split:
        return l_keyed.join(r_keyed, F.col(k) == F.col(rk), "full").drop(k, rk)
    matched = l_keyed.join(r_keyed, F.col(k) == F.col(rk), "left").drop(k, rk)
    only_right = r_keyed.join(l_keyed.select(k), F.col(rk) == F.col(k), "left_anti").drop(rk)
    return matched.unionByName(only_right, allowMissingColumns=True)


def left_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    lookup_key: str | Sequence[str],
    attributes: Mapping[str, str],
    last_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Attach ``attributes`` (output name -> lookup column); NULL where the key, of one or several columns, is unknown.

    With ``last_by`` the lookup is reduced to one row per key first, the last in that order. ``df`` may
    be a stream.
    """
    keys, lookup_keys = ([k] if isinstance(k, str) else list(k) for k in (key, lookup_key))
    if last_by is not None:
        lookup = dedupe_first(lookup, lookup_keys, last_by)
    own = [f"__lookup_key{i}" for i in range(len(keys))]
    slim = lookup.select(
        *[F.col(c).alias(n) for c, n in zip(lookup_keys, own, strict=True)],
        *[F.col(c).alias(n) for n, c in attributes.items()],
    )
    same = reduce(and_, [F.col(k) == F.col(n) for k, n in zip(keys, own, strict=True)])
    return df.join(slim, same, "left").drop(*own)


def in_force(times: DataFrame, versions: DataFrame, at: str, valid_from: str) -> DataFrame:
    """``times`` with the greatest ``valid_from`` of ``versions`` up to ``at``; NULL before the first version.

    An as-of match of two short lists, say the polls of a batch and the versions of a table: both are ordered in one
    task, as one timeline. Match rows by the version that is found, not by time.
    """
    known = versions.select(valid_from).distinct()
    line = times.withColumn("__at", F.col(at)).unionByName(
        known.withColumn("__at", F.col(valid_from)), allowMissingColumns=True
    )
    # At equal times the version comes first: it is in force from that moment on.
    order = Window.orderBy("__at", F.col(valid_from).isNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("__version", F.last(valid_from, ignorenulls=True).over(order))
    rows = found.where(F.col(valid_from).isNull()).select(*times.columns, F.col("__version").alias(valid_from))
    return rows
