"""Pick one row per key.

Both operators are a ``row_number() = 1`` filter. Catalyst turns that into a group limit that runs
*before* the shuffle as well as after it, so a key that holds a third of the table leaves each map
task as a single row: no skew treatment is needed on top.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def total_order(df: DataFrame, first: Sequence[Column], skip: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by every column of ``df`` not in ``skip``.

    A total order makes the pick repeatable: a task re-run after a lost executor, or a second branch of
    the same plan, chooses the same row.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in set(skip)]
    return [*first, *rest]


def _first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order. NULL keys form one group."""
    return _first_row(df, keys, order)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[Column] | None = None
) -> DataFrame:
    """Row with the greatest ``ts`` per key; ties go to the first row in ``tie_break`` order, by default to the
    greater remaining columns, NULL being the least: the rule that a streaming maximum can follow as well."""
    order = [F.col(ts).desc_nulls_last()]
    if tie_break is None:
        order += [F.col(c).desc_nulls_last() for c in df.columns if c not in {*keys, ts}]
    else:
        order += list(tie_break)
    return _first_row(df, keys, order)
