"""Turn a row with two ends into two rows, reading the input once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_sides(
    df: DataFrame,
    sides: Mapping[str, Mapping[str, Column]],
    keep: Sequence[str] = (),
    tag: str = "side",
) -> DataFrame:
    """One output row per input row and side: ``keep`` columns, the side's columns and a ``tag``.

    A ``UNION ALL`` of two selects gives the same rows but scans the input twice.
    """
    entries = [
        F.struct(F.lit(name).alias(tag), *[c.alias(alias) for alias, c in cols.items()])
        for name, cols in sides.items()
    ]
    return df.select(*keep, F.inline(F.array(*entries)))
