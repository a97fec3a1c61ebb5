"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles. Sets that are equal become one class first. Each tree then branches
the classes recursively: a node picks one or two coordinates of the MinHash signature by its own hash (more
than 1 / similarity on average, so a similar pair is expected to stay together in some child) and a class goes
to the child named by its minwise token there. Nodes of at most ``LEAF`` classes are compared exhaustively on
two-bit sketches; larger ones branch on. Independent trees are repeated until pairs at the threshold are met
with probability ``recall``. A node that does not get smaller, as one of very many near copies, is split into
blocks, and all pairs of blocks are compared.

No pairs become rows: a task gives out a forest of the candidate pairs it saw. The components of those are
compared again on full sets, block by block, and only confirmed links make up the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.blocks import block_pairs
from tripmart.llm.components import connected_components, settle
from tripmart.llm.wordhash import mix, sequences, split_groups, text_chunks, words
from tripmart.sources.scratch import scratch_path

#: Coordinates of a signature. Two bits of each make up the sketch of 32 bytes.
COORDINATES = 128
#: Classes that a node compares exhaustively without branching again.
LEAF = 2048
#: Classes of a block where full sets are compared.
BLOCK = 256
#: Rounds of branching after the first, for nodes that are still too large.
_MORE_ROUNDS = 1
_LEVELS_A_ROUND = 2
#: A random pair of documents shares about this part of its minwise tokens.
_CHANCE = 0.1
#: Stands for a null id.
_NULL_ID = (1 << 63) - 1

_U = np.uint64
_SEED = 0x2545F4914F6CDD1D


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _U(_SEED)) | _U(1)


def _shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, 48-bit hash) of the distinct shingles, sorted. A row of fewer words has its whole sequence as one."""
    found = words(data, bounds, lower=True)
    n = len(found.hash)
    count = np.bincount(found.row, minlength=len(bounds) - 1)
    starts = np.cumsum(count) - count
    rows, keys = [], []
    if n >= width:
        inside = np.flatnonzero(found.row[: n - width + 1] == found.row[width - 1 :])
        rows.append(found.row[inside])
        keys.append(sequences(found.hash, width)[inside])
    for short in range(1, width):
        at = np.flatnonzero(count == short)
        if len(at):
            rows.append(at)
            keys.append(sequences(found.hash, short)[starts[at]] ^ _U(short))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    both = (np.concatenate(rows).astype(np.uint64) << _U(48)) | (np.concatenate(keys) >> _U(16))
    both = np.unique(both)
    return (both >> _U(48)).astype(np.int64), both & _U((1 << 48) - 1)


def _signatures(row: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature n x COORDINATES of uint32, sketch n x 4 of uint64) of rows 0..n-1, all of which have shingles."""
    starts = np.searchsorted(row, np.arange(n))
    base = mix(key)
    least = np.empty((n, COORDINATES), dtype=np.uint32)
    for c, factor in enumerate(_multipliers()):
        least[:, c] = np.minimum.reduceat(((base * factor) >> _U(32)).astype(np.uint32), starts)
    hashed = mix(least.astype(np.uint64) + (np.arange(COORDINATES, dtype=np.uint64) << _U(32)))
    planes = [
        np.packbits(((hashed >> _U(bit)) & _U(1)).astype(np.uint8), axis=1).view(np.uint64) for bit in (7, 23)
    ]
    return least, np.hstack(planes)


_SETS = "__id long, __n int, __hi long, __lo long, __least binary, __sketch binary"


def _describe(width: int):
    """Rows (id, text) to rows of ``_SETS``; no shingles: n is 0 and the rest null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, to, data, bounds in text_chunks(batch.column(1)):
                row, key = _shingle_sets(data, bounds, width)
                n = np.bincount(row, minlength=to - at)
                some = np.flatnonzero(n)
                hi = lo = np.zeros(0, np.int64)
                least, sketch = np.zeros((0, COORDINATES), np.uint32), np.zeros((0, 4), np.uint64)
                if len(some):
                    dense = np.searchsorted(some, row)
                    starts = np.searchsorted(dense, np.arange(len(some)))
                    hi = np.add.reduceat(mix(key), starts).view(np.int64)
                    lo = np.add.reduceat(mix(key ^ _U(_SEED)), starts).view(np.int64)
                    least, sketch = _signatures(dense, key, len(some))
                where = np.full(to - at, -1)
                where[some] = np.arange(len(some))
                take = pa.array(where, pa.int64(), mask=where < 0)
                columns = [
                    ids.slice(at, to - at),
                    pa.array(n, pa.int32()),
                    pa.array(hi, pa.int64()).take(take),
                    pa.array(lo, pa.int64()).take(take),
                    pa.array([x.tobytes() for x in least], pa.binary()).take(take),
                    pa.array([x.tobytes() for x in sketch], pa.binary()).take(take),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["__id", "__n", "__hi", "__lo", "__least", "__sketch"])

    return run


def _branch(path: np.ndarray, least: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``least``, path) after so many levels from the node ``path`` that each row is in."""
    at = np.arange(len(path))
    for _ in range(levels):
        pick = mix(path ^ _U(_SEED))
        one = (pick % _U(COORDINATES)).astype(np.int64)
        second = np.flatnonzero((pick >> _U(40)) % _U(4) == 0)
        two = (one[second] + 1 + ((pick[second] >> _U(20)) % _U(COORDINATES - 1)).astype(np.int64)) % COORDINATES
        source = np.concatenate([np.arange(len(path)), second])
        coordinate = np.concatenate([one, two])
        token = least[at[source], coordinate].astype(np.uint64)
        path = mix(path[source] ^ mix(token + (coordinate.astype(np.uint64) << _U(40))))
        at = at[source]
    return at, path


def survival(levels: int, similarity: float) -> float:
    """Probability that a pair of this similarity shares a node of a tree after so many levels.

    A node picks two coordinates in a quarter of cases, one otherwise.
    """
    alive = 1.0
    for _ in range(levels):
        lost = 1 - similarity * alive
        alive = 1 - (0.75 * lost + 0.25 * lost * lost)
    return alive


def _binomial(n: int, p: float) -> np.ndarray:
    """Probabilities of 0 to n."""
    out = np.zeros(n + 1)
    out[0] = 1.0
    for _ in range(n):
        out[1:] = out[1:] * (1 - p) + out[:-1] * p
        out[0] *= 1 - p
    return out


def _similar(threshold: float, recall: float) -> int:
    """Least number of equal coordinates asked of a pair. Pairs at the threshold have fewer in some 30,000 cases
    once, and in no more than half of the cases that the recall leaves.
    """
    p = threshold + (1 - threshold) / 4
    least = math.floor(COORDINATES * p - 4 * math.sqrt(COORDINATES * p * (1 - p)))
    chances = _binomial(COORDINATES, p)
    while chances[:least].sum() > (1 - recall) / 2:
        least -= 1
    return least


def missed(levels: int, trees: int, threshold: float, recall: float) -> float:
    """Probability that a pair just at the threshold shares no node of any tree or fails the filter of sketches.

    All trees and the sketch read the same coordinates, so it is averaged over the number of those that agree.
    """
    least = _similar(threshold, recall)
    total = 0.0
    for k, chance in enumerate(_binomial(COORDINATES, threshold)):
        apart = (1 - survival(levels, k / COORDINATES)) ** trees
        other = _binomial(COORDINATES - k, 0.25)[: max(least - k, 0)].sum()
        total += chance * (1 - (1 - apart) * (1 - other))
    return float(total)


def trees_needed(levels: int, threshold: float, recall: float) -> int:
    """Least number of trees that reach the recall."""
    trees = 1
    while missed(levels, trees, threshold, recall) > 1 - recall:
        trees += 1
    return trees


_NODES = "__path long, __id long, __n int, __sketch binary"


def _enter(trees: int, levels: int):
    """Rows (id, n, least, sketch): a row for each node of depth ``levels`` in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                least = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint32).reshape(-1, COORDINATES)
                for tree in range(trees):
                    root = np.full(part.num_rows, mix(np.array([tree + 1], np.uint64) * _U(_SEED))[0])
                    yield _nodes(part, *_branch(root, least, levels))

    return run


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, n, least, sketch, path) of nodes that are too large: rows of nodes some levels below."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            least = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            path = part.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            yield _nodes(part, *_branch(path, least, _LEVELS_A_ROUND))


def _nodes(part: pa.RecordBatch, at: np.ndarray, path: np.ndarray) -> pa.RecordBatch:
    take = pa.array(at)
    return pa.RecordBatch.from_arrays(
        [pa.array(path.view(np.int64)), *(part.column(k).take(take) for k in (0, 1, 3))],
        ["__path", "__id", "__n", "__sketch"],
    )


def _compare(threshold: float, recall: float):
    """Rows of ``_NODES``, sorted by path, with a side (0: compared with all of the node, 1 and 2: across)."""
    least_equal = _similar(threshold, recall)

    def edges(table: pa.Table) -> pa.RecordBatch:
        path = table.column("__path").to_numpy()
        ids = table.column("__id").to_numpy()
        size = table.column("__n").to_numpy().astype(np.int64)
        side = table.column("__side").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("__sketch").to_pylist()), np.uint64).reshape(-1, 4)
        left, right, label = [], [], np.arange(len(path))
        pending = 0
        for step in range(1, len(path)):
            at = np.flatnonzero(path[:-step] == path[step:])
            if not len(at):
                break
            to = at + step
            near = np.minimum(size[at], size[to]) >= threshold * np.maximum(size[at], size[to])
            near &= (side[at] == 0) | (side[at] != side[to])
            # A pair that is joined already needs no second comparison.
            near &= label[at] != label[to]
            at, to = at[near], to[near]
            differ = (sketch[at, 0] ^ sketch[to, 0]) | (sketch[at, 2] ^ sketch[to, 2])
            apart = np.bitwise_count(differ).astype(np.int64)
            differ = (sketch[at, 1] ^ sketch[to, 1]) | (sketch[at, 3] ^ sketch[to, 3])
            apart += np.bitwise_count(differ)
            equal = COORDINATES - apart >= least_equal
            if equal.any():
                left.append(at[equal])
                right.append(to[equal])
                pending += int(equal.sum())
                if pending > 100_000 or step % 16 == 0:
                    label = settle(len(path), np.concatenate(left), np.concatenate(right))
                    moved = np.flatnonzero(label != np.arange(len(path)))
                    left, right, pending = [moved], [label[moved]], 0
        if left:
            label = settle(len(path), np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(label != np.arange(len(path)))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[moved], pa.int64()), pa.array(ids[label[moved]], pa.int64())], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in split_groups(batches, "__path"):
            yield edges(table)

    return run


def _candidates(spark: SparkSession, classes: DataFrame, threshold: float, recall: float, base: str) -> DataFrame:
    """Edges (a, b) that connect all candidate pairs of ``classes``."""
    n = classes.count()
    first = max(1, round(math.log(max(4 * n / LEAF, 1)) / math.log(1 / _CHANCE)))
    most_levels = first + _MORE_ROUNDS * _LEVELS_A_ROUND
    trees = trees_needed(most_levels, threshold, recall)
    found = []
    columns = ["__id", "__n", "__least", "__sketch"]
    frontier = classes.select(*columns).mapInArrow(_enter(trees, first), _NODES)
    for k in range(_MORE_ROUNDS + 1):
        frontier.write.parquet(f"{base}/nodes{k}")
        frontier = spark.read.parquet(f"{base}/nodes{k}")
        large = frontier.groupBy("__path").agg(F.count("*").alias("__count")).where(F.col("__count") > LEAF)
        large.write.parquet(f"{base}/large{k}")
        large = spark.read.parquet(f"{base}/large{k}")
        leaves = frontier.join(large, "__path", "left_anti").withColumn("__side", F.lit(0))
        found.append(_search(leaves, threshold, recall, f"{base}/edges{k}"))
        if not large.take(1):
            break
        rest = frontier.join(large, "__path")
        if k == _MORE_ROUNDS:
            pairs = block_pairs(rest, "__path", "__id", "__count", LEAF).withColumn("__path", F.col("__pair"))
            found.append(_search(pairs, threshold, recall, f"{base}/edges-blocks"))
        else:
            again = rest.select("__path", "__id").join(classes.select(*columns), "__id")
            frontier = again.select(*columns, "__path").mapInArrow(_deeper, _NODES)
    return spark.read.parquet(*found)


def _search(rows: DataFrame, threshold: float, recall: float, path: str) -> str:
    rows = rows.select("__path", "__id", "__n", "__sketch", "__side")
    rows = rows.repartition("__path").sortWithinPartitions("__path")
    rows.mapInArrow(_compare(threshold, recall), "a long, b long").write.parquet(path)
    return path


def _set_rows(width: int):
    """Rows (id, text, group, count) to rows (id, group, count, set): the set as sorted 48-bit hashes in 8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in text_chunks(batch.column(1)):
                row, key = _shingle_sets(data, bounds, width)
                cuts = np.searchsorted(row, np.arange(to - at + 1))
                sets = [key[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(sets, pa.binary())],
                    ["__id", "__group", "__count", "__set"],
                )

    return run


def _shared(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections. Shingles of one set only are left out; the rest goes in slices."""
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    more = times[place] > 1
    owner, place = owner[more], (np.cumsum(times > 1) - 1)[place[more]]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for low in range(0, int((times > 1).sum()), columns):
        a, b = np.searchsorted(place, [low, low + columns])
        block = np.zeros((len(sets), columns), dtype=np.float32)
        block[owner[a:b], place[a:b] - low] = 1
        out += block @ block.T
    return np.rint(out).astype(np.int64)


def _confirm(percent: int):
    """Rows (pair, id, set) sorted by pair: a forest of the links of each pair of blocks, on full sets."""

    def links(ids: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in sets])
        shared = _shared(sets)
        union = size[:, None] + size[None, :] - shared
        a, b = np.nonzero(np.triu(100 * shared >= percent * union, 1))
        label = settle(len(ids), a, b)
        moved = np.flatnonzero(label != np.arange(len(ids)))
        return ids[moved], ids[label[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in split_groups(batches, "__pair"):
            pair = table.column("__pair").to_numpy()
            ids = table.column("__id").to_numpy()
            sets = table.column("__set").to_pylist()
            cuts = np.append(np.flatnonzero(np.append(True, pair[1:] != pair[:-1])), len(pair))
            a, b = [], []
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if high - low > 1:
                    x, y = links(ids[low:high], [np.frombuffer(s, np.uint64) for s in sets[low:high]])
                    a.append(x)
                    b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"]
                )

    return run


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    recall: float = 0.9999,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Sets are the distinct shingles of ``shingle_words`` words, A-Z lower-cased; documents are linked where
    100 * shared >= ``percent`` * union, counted on full sets. ``component_id`` is the least id that links
    reach, ``kept`` tells whether it is the document's own. ``recall``: least probability that the trees put a
    pair just at the threshold together; pairs above it, and those connected by others, have more.

    Defined cases: fewer words than a shingle make up one shingle; a null text, or one without words, has no
    shingles and no links; rows of equal id are one document, linked to what either is linked to; a null id is
    an id of its own, larger than all others, and stays null in the result; an empty table gives no rows.
    """
    spark = docs.sparkSession
    base = scratch_path(spark, "neardup")
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("__id")
    texts = docs.select(key, F.col(text_col).cast("string").alias("__text"))
    texts.mapInArrow(_describe(shingle_words), _SETS).write.parquet(f"{base}/sets")
    sets = spark.read.parquet(f"{base}/sets")

    classes = (
        sets.where("__n > 0")
        .groupBy("__hi", "__lo")
        .agg(
            F.min("__id").alias("__id"),
            F.first("__n").alias("__n"),
            F.first("__least").alias("__least"),
            F.first("__sketch").alias("__sketch"),
        )
    )
    classes.write.parquet(f"{base}/classes")
    classes = spark.read.parquet(f"{base}/classes")
    candidates = _candidates(spark, classes, percent / 100, recall, base)

    # Full sets of those classes only that a candidate pair has; a repeated id brings all its texts along.
    groups = connected_components(candidates).withColumnRenamed("component", "__group")
    sizes = groups.groupBy("__group").agg(F.count("*").alias("__count"))
    wanted = groups.join(sizes, "__group").select(F.col("node").alias("__id"), "__group", "__count")
    # By shuffle and hash at any size: the plan stays the same as tables grow, and texts are not sorted.
    full = texts.join(wanted.hint("shuffle_hash"), "__id").select("__id", "__text", "__group", "__count")
    full = full.mapInArrow(_set_rows(shingle_words), "__id long, __group long, __count long, __set binary")
    pairs = block_pairs(full.where(F.length("__set") > 0), "__group", "__id", "__count", BLOCK)
    pairs = pairs.select("__pair", "__id", "__set").repartition("__pair").sortWithinPartitions("__pair")
    pairs.mapInArrow(_confirm(percent), "a long, b long").write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")

    named = classes.select("__hi", "__lo", F.col("__id").alias("b"))
    members = sets.where("__n > 0").select("__id", "__hi", "__lo").join(named, ["__hi", "__lo"])
    members = members.select(F.col("__id").alias("a"), "b")
    components = connected_components(links.union(members))
    components = components.select(F.col("node").alias("__id"), "component")
    least = F.coalesce("component", "__id")
    return (
        sets.select("__id", "__n")
        .join(components, "__id", "left")
        .select(
            F.nullif("__id", F.lit(_NULL_ID)).alias(id_col),
            F.col("__n").cast("long").alias("n_shingles"),
            F.nullif(least, F.lit(_NULL_ID)).alias("component_id"),
            (least == F.col("__id")).alias("kept"),
        )
    )
