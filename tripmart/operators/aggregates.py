"""Grouped counts and what is derived from them. All of them combine on the map side first."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratio_2dp
from .pick import dedupe_first


def count_distinct_multi(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Several exact distinct counts per group; ``columns`` maps output name to input column.

    Catalyst expands the rows once and aggregates on (key, value) before it counts, so a hot key is
    spread over its values.
    """
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(n) for n, c in columns.items()])


def count_where(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Conditional counts per group (or over the whole input when ``keys`` is empty)."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def peak_bucket(df: DataFrame, keys: Sequence[str], bucket: str, count: str = "n") -> DataFrame:
    """Most frequent bucket per key with its count; the smallest bucket wins a tie."""
    counted = df.groupBy(*keys, bucket).agg(F.count("*").alias(count))
    return dedupe_first(counted, keys, [F.col(count).desc(), F.col(bucket).asc_nulls_first()])


def share_of_total(counted: DataFrame, count: str, share: str, few_groups: bool = False) -> DataFrame:
    """Add each group's percentage of the sum of all counts (two decimals).

    The total is a scalar subquery over the grouped counts, so a large number of groups never lands in
    one task; the shuffle behind the counts is reused for it. Say ``few_groups`` only if the groups come
    from a fixed set of values: one window over those few rows then spares the second pass.
    """
    if few_groups:
        total = F.sum(count).over(Window.partitionBy())
    else:
        total = counted.agg(F.sum(count)).scalar()
    return counted.withColumn(share, ratio_2dp(F.col(count), total, scale=100))


def top_k(df: DataFrame, by: str, tie_break: Sequence[str], k: int) -> DataFrame:
    """The ``k`` greatest rows; each task keeps at most ``k`` rows before they meet."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie_break).limit(k)


def distinct_sketch(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], lg_k: int = 14) -> DataFrame:
    """A sketch per group for each of ``columns`` (output name -> input column), from which distinct counts follow.

    Sketches of groups can be merged, so distinct counts of any period come from those of its days, without the
    rows. A sketch takes up to 2**lg_k bytes and is exact for small groups.
    """
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, F.lit(lg_k)).alias(n) for n, c in columns.items()])


def merge_sketches(sketches: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct counts of larger groups, estimated from the sketches of smaller ones."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])


def sketch_error(lg_k: int = 14, deviations: float = 5.0) -> float:
    """Relative error that a merged estimate stays below, at so many standard errors of 1.04 / sqrt(2**lg_k).

    At five, one estimate in two million lies outside.
    """
    return deviations * 1.04 / math.sqrt(1 << lg_k)
