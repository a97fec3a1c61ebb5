"""Connected components of a graph held as a table of edges, by alternating star contraction.

Large star: every node links its larger neighbours to the least node it knows. Small star: every node links
its smaller neighbours, and itself, to the least of them. Repeated in turn, this leaves one star per component
whose centre is the least node. Each round is aggregations and joins, so a node with any number of links is
combined on the map side and may be split by the join. A round is written to the shared scratch folder: the
lineage stays short and a lost executor costs no earlier round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.sources.scratch import scratch_path

_EDGE = "__a long, __b long"


class _Forest:
    """Disjoint sets of one task; the least member names a set."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        top = x
        while (up := self.parent.get(top, top)) != top:
            top = up
        while (up := self.parent.get(x, x)) != top:
            self.parent[x] = top
            x = up
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def settle(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member reachable over the pairs (a, b) from each of 0..size-1; arrays of one task."""
    label = np.arange(size)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _local_forest(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Stars of the edges of one task. Beyond ``most`` nodes they are given out and a new forest begins."""

    def stars(forest: _Forest) -> pa.RecordBatch:
        nodes = list(forest.parent)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([forest.find(x) for x in nodes], pa.int64())], ["__a", "__b"]
        )

    forest = _Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        if len(forest.parent) > most:
            yield stars(forest)
            forest = _Forest()
    yield stars(forest)


def _normal(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node (``__a``) to the smaller one (``__b``), without loops."""
    return (
        edges.where("__a <> __b")
        .select(F.greatest("__a", "__b").alias("__a"), F.least("__a", "__b").alias("__b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("__b").alias("__a"), F.col("__a").alias("__b")))
    least = both.groupBy("__a").agg(F.least("__a", F.min("__b")).alias("__m"))
    return _normal(both.where("__b > __a").join(least, "__a").select(F.col("__b").alias("__a"), F.col("__m").alias("__b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("__a").agg(F.min("__b").alias("__m"))
    moved = edges.join(least, "__a").select(F.col("__b").alias("__a"), F.col("__m").alias("__b"))
    return _normal(moved.union(least.select("__a", F.col("__m").alias("__b"))))


def _state(edges: DataFrame) -> tuple:
    """Changes if the set of edges does."""
    part = F.xxhash64("__a", "__b")
    row = edges.agg(
        F.count("*"), F.sum(part.cast("decimal(20,0)")), F.sum((part % 1_000_003) * (part % 999_983))
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (least node that is reachable) of every node that has an edge to another node.

    ``edges``: two columns of 64-bit integers without nulls; direction, repeated edges and loops don't matter.
    No edges: no rows. The result is read from a table in the scratch folder.
    """
    spark = edges.sparkSession
    base = scratch_path(spark, "components")
    now = edges.select(F.col(a).cast("long").alias("__a"), F.col(b).cast("long").alias("__b"))
    now = _normal(now.mapInArrow(_local_forest, _EDGE))
    before: tuple | None = None
    for k in range(most_rounds):
        now.write.parquet(f"{base}/{k}")
        now = spark.read.parquet(f"{base}/{k}")
        state = _state(now)
        if state == before or not state[0]:
            members = now.select(F.col("__a").alias("node"), F.col("__b").alias("component"))
            return members.union(now.select(F.col("__b"), F.col("__b")).distinct())
        before = state
        now = _small_star(_large_star(now))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
