"""Near-duplicate vectors: signs of random projections in several tables, exact cosine, connected components.

Equal vectors become one class first. A table cuts space by ``bits`` random hyperplanes; the signs of a vector
name its bucket. ``bits`` grows with the logarithm of the number of classes, so buckets of unlike vectors stay
small, and as many tables are made as pairs at the threshold need to meet with probability ``recall``.

What is shuffled for every table is a key, a class and a sketch of 192 signs, not the vector. Within a bucket
sketches are compared by the number of signs in which they differ, and only classes that have another one near
go on, to buckets of their own, where they meet their vectors and all cosines are computed in double precision.
Buckets that are large all the same are split in blocks, and every pair of blocks is compared on its own.

A pair is counted in the first table where its signs agree, so counts need no list of pairs; what a task gives
out is a count per vector and a forest of links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.blocks import block_pairs
from tripmart.llm.components import connected_components, settle
from tripmart.llm.wordhash import mix, split_groups
from tripmart.sources.scratch import scratch_path

#: Classes of unlike vectors that a bucket should have at most.
_BUCKET = 1024
#: Classes of a bucket, or of a block of one, that are compared at once: by sketch, and by vector.
SKETCH_BLOCK = 8192
BLOCK = 1024
#: Signs of a sketch, in words of 64.
SKETCH_WORDS = 3
#: The part of the pairs that may be missed which the sketches may miss; the tables have the rest.
_SKETCH_SHARE = 0.1
_NULL_ID = (1 << 63) - 1
_SEED = 20_240_613


def _differ(threshold: float) -> float:
    """Probability that one random hyperplane parts two vectors at the threshold."""
    return math.acos(threshold) / math.pi


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits of a table, number of tables) for so many classes."""
    same = 1 - _differ(threshold)
    bits = max(4, min(30, math.ceil(math.log2(max(n, 1) / _BUCKET))))
    missed = (1 - recall) * (1 - _SKETCH_SHARE)
    return bits, max(1, math.ceil(math.log(missed) / math.log(1 - same**bits)))


def most_differing(threshold: float, recall: float) -> int:
    """Signs in which two sketches may differ: pairs at the threshold differ in more with the sketches' share of misses."""
    signs, p = 64 * SKETCH_WORDS, _differ(threshold)
    left = 1.0
    for k in range(signs):
        left -= math.comb(signs, k) * p**k * (1 - p) ** (signs - k)
        if left <= (1 - recall) * _SKETCH_SHARE:
            return k
    return signs


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, array) to rows (id, bytes of doubles); null where a vector can't be linked."""
    for batch in batches:
        out = []
        for x in batch.column(1).to_pylist():
            v = None
            if x and None not in x:
                v = np.array(x, dtype="<f8") + 0.0
                if not np.isfinite(v).all() or not v.any():
                    v = None
            out.append(None if v is None else v.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["__id", "__vec"])


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


_SKETCH = [f"__s{k}" for k in range(SKETCH_WORDS)]
_SIGNED = "__class long, __id long, __copies long, __vec binary, __keys array<long>, " + ", ".join(
    f"{x} long" for x in _SKETCH
)


def _sign(bits: int, tables: int):
    """Rows (class, id, copies, vec): the key of its bucket in each table, and the sketch, are added."""
    signs = max(bits * tables, 64 * SKETCH_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = (np.uint64(1) << np.arange(64, dtype=np.uint64)).astype(np.uint64)
        place = (np.arange(1, tables + 1, dtype=np.uint64)) << np.uint64(32)
        for batch in batches:
            raw = batch.column(3).to_pylist()
            size = np.array([len(x) // 8 for x in raw])
            for dimension in np.unique(size):
                if dimension not in planes:
                    rng = np.random.default_rng(_SEED + int(dimension))
                    planes[dimension] = rng.standard_normal((int(dimension), signs))
                every = np.flatnonzero(size == dimension)
                for low in range(0, len(every), 2048):
                    at = every[low : low + 2048]
                    sign = (_unit([raw[k] for k in at]) @ planes[dimension] > 0).astype(np.uint64)
                    codes = sign[:, : bits * tables].reshape(len(at), tables, bits) @ weight[:bits]
                    keys = mix(mix(codes + place) ^ np.uint64(dimension)).view(np.int64)
                    sketch = sign[:, : 64 * SKETCH_WORDS].reshape(len(at), SKETCH_WORDS, 64) @ weight
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(at) + 1, dtype=np.int32) * tables), pa.array(keys.ravel())
                    )
                    part = [batch.column(k).take(pa.array(at)) for k in range(4)]
                    words = [pa.array(sketch[:, k].copy().view(np.int64)) for k in range(SKETCH_WORDS)]
                    names = ["__class", "__id", "__copies", "__vec", "__keys", *_SKETCH]
                    yield pa.RecordBatch.from_arrays([*part, lists, *words], names)

    return run


_NEAR = "__key long, __table int, __class long"


def _sift(bits: int, most: int):
    """Rows (key, table, class, side, sketch), sorted by key: the classes that have another one near in the bucket.

    A pair that agrees in an earlier table is left to that one, as far as the sketch holds the signs of it.
    """
    signs = 64 * SKETCH_WORDS

    def held(t: int) -> list[np.ndarray]:
        """Masks of the earlier tables whose signs the sketch holds."""
        masks = []
        for earlier in range(min(t, signs // bits)):
            mask = ((1 << bits) - 1) << (earlier * bits)
            masks.append(np.array([mask >> (64 * k) & (2**64 - 1) for k in range(SKETCH_WORDS)], np.uint64))
        return masks

    def near(t: int, side: np.ndarray, sketch: np.ndarray) -> np.ndarray:
        n = len(side)
        some = np.zeros(n, dtype=bool)
        masks = held(t)
        for low in range(0, n, 128):
            high = min(low + 128, n)
            apart = [sketch[low:high, None, k] ^ sketch[None, low:, k] for k in range(SKETCH_WORDS)]
            count = sum(np.bitwise_count(x).astype(np.uint16) for x in apart)
            a, b = np.nonzero(count <= most)
            ok = a < b
            if side.any():
                ok &= side[low + a] != side[low + b]
            a, b = a[ok], b[ok]
            if len(a) and masks:
                own = np.stack([x[a, b] for x in apart], axis=1)
                met = np.zeros(len(a), dtype=bool)
                for mask in masks:
                    met |= ~(own & mask).any(axis=1)
                a, b = a[~met], b[~met]
            some[low + a] = True
            some[low + b] = True
        return some

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in split_groups(batches, "__key"):
            key, t, classes, side = (table.column(x).to_numpy() for x in ("__key", "__table", "__class", "__side"))
            bucket = table.column("__bucket").to_numpy()
            sketch = np.stack([table.column(x).to_numpy().view(np.uint64) for x in _SKETCH], axis=1)
            cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            kept = np.zeros(len(key), dtype=bool)
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if high - low > 1:
                    kept[low:high] = near(int(t[low]), side[low:high], sketch[low:high])
            if kept.any():
                columns = [pa.array(bucket[kept]), pa.array(t[kept]), pa.array(classes[kept])]
                yield pa.RecordBatch.from_arrays(columns, ["__key", "__table", "__class"])

    return run


_FOUND = "__class long, __id long, __links long, __to long"
_COMPARED = ("__key", "__table", "__class", "__id", "__copies", "__side")


def _compare(threshold: float):
    """Rows of ``_COMPARED`` with keys and vector, sorted by key: what each class gains in links, and a link of the forest."""

    def bucket(t, classes, ids, copies, side, keys, raw) -> list[np.ndarray]:
        unit = _unit(raw)
        cosine = unit @ unit.T
        near = np.triu(cosine >= threshold, 1)
        if side.any():
            near &= side[:, None] != side[None, :]
        a, b = np.nonzero(near)
        if len(a) and t:
            earlier = np.zeros(len(a), dtype=bool)
            for low in range(0, len(a), 200_000):
                part = slice(low, low + 200_000)
                earlier[part] = (keys[a[part], :t] == keys[b[part], :t]).any(axis=1)
            a, b = a[~earlier], b[~earlier]
        links = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(
            b, weights=copies[a], minlength=len(ids)
        )
        some = np.flatnonzero(links)
        label = settle(len(ids), a, b)
        return [classes[some], ids[some], links[some].astype(np.int64), ids[label[some]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in split_groups(batches, "__key"):
            key, t, classes, ids, copies, side = (table.column(x).to_numpy() for x in _COMPARED)
            keys = table.column("__keys").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
            raw = table.column("__vec").to_pylist()
            cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            out = []
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if high - low > 1 and len({(t[k], len(raw[k])) for k in range(low, high)}) == 1:
                    s = slice(low, high)
                    out.append(bucket(int(t[low]), classes[s], ids[s], copies[s], side[s], keys[s], raw[s]))
            if out:
                columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["__class", "__id", "__links", "__to"])

    return run


def _dealt(rows: DataFrame, most: int, path: str) -> tuple[DataFrame, DataFrame]:
    """Groups of ``__key`` of at most so many rows, and the pairs of blocks of larger ones.

    Those have a key of their own, a ``__side``, and the key of the whole group as ``__bucket``. The keys of large
    groups are written to ``path``.
    """
    spark = rows.sparkSession
    large = rows.groupBy("__key").agg(F.count("*").alias("__count")).where(F.col("__count") > most)
    large.write.parquet(path)
    large = spark.read.parquet(path)
    blocks = block_pairs(rows.join(large, "__key"), "__key", "__class", "__count", most // 2)
    blocks = blocks.withColumnsRenamed({"__key": "__bucket", "__pair": "__key"})
    return rows.join(large, "__key", "left_anti"), blocks.select(*rows.columns, "__side", "__bucket")


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows by key. A group that is not a pair of blocks gets its side and bucket here, past the shuffle."""
    rows = rows.repartition("__key").sortWithinPartitions("__key")
    return rows if "__side" in rows.columns else rows.select("*", F.lit(0).alias("__side"), F.col("__key").alias("__bucket"))


def near_vectors(
    rows: DataFrame,
    threshold: float = 0.9,
    recall: float = 0.999,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per row: ``id_col``, ``n_links`` (other vectors of at least this cosine that were found),
    ``component_id`` (least id that links reach), ``kept`` (whether it is the row's own).

    No link below the threshold is made; one at the threshold is found with probability ``recall``, a closer one
    with more, an equal vector always.

    Defined cases: a vector that is null, empty, zero, or holds a null or a component that is not finite links
    with nothing; vectors of different length don't link; rows of equal id are separate vectors but one node of
    the graph; a null id is an id larger than all others and stays null; an empty table gives no rows.
    """
    spark = rows.sparkSession
    base = scratch_path(spark, "vectors")
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("__id")
    vectors = rows.select(key, F.col(vector_col).cast("array<double>").alias("__array"))
    vectors = vectors.mapInArrow(_vectors, "__id long, __vec binary")
    classed = vectors.withColumn("__class", F.when(F.col("__vec").isNotNull(), F.xxhash64("__vec")))
    classes = (
        classed.where("__vec IS NOT NULL")
        .groupBy("__class", "__vec")
        .agg(F.min("__id").alias("__id"), F.count("*").alias("__copies"))
        .select("__class", "__id", "__copies", "__vec")
    )
    classes.write.parquet(f"{base}/classes")
    classes = spark.read.parquet(f"{base}/classes")
    bits, tables = plan_tables(classes.count(), threshold, recall)
    # Signs are computed once: a product of floats may differ in its last digit from one batch to the next.
    classes.mapInArrow(_sign(bits, tables), _SIGNED).write.parquet(f"{base}/signed")
    signed = spark.read.parquet(f"{base}/signed")

    sketches = signed.select("__class", *_SKETCH, F.posexplode("__keys").alias("__table", "__key"))
    for name, part in zip(("few", "many"), _dealt(sketches, SKETCH_BLOCK, f"{base}/large-sketches"), strict=True):
        sifted = _grouped(part).mapInArrow(_sift(bits, most_differing(threshold, recall)), _NEAR)
        sifted.write.parquet(f"{base}/near-{name}")
    # A class of a large bucket may be near others in several pairs of blocks.
    near = spark.read.parquet(f"{base}/near-few").union(spark.read.parquet(f"{base}/near-many").distinct())

    vectors = signed.select("__class", "__id", "__copies", "__keys", "__vec")
    for name, part in zip(("small", "blocks"), _dealt(near, BLOCK, f"{base}/large"), strict=True):
        _grouped(part.join(vectors, "__class")).mapInArrow(_compare(threshold), _FOUND).write.parquet(f"{base}/found-{name}")
    found = spark.read.parquet(f"{base}/found-small", f"{base}/found-blocks")

    links = found.groupBy("__class").agg(F.sum("__links").alias("__links"))
    known = classes.select("__class", F.col("__id").alias("__first"), "__copies").join(links, "__class", "left")
    members = classed.select("__id", "__class").join(known, "__class", "left")
    edges = found.select(F.col("__id").alias("a"), F.col("__to").alias("b")).union(
        members.where("__first IS NOT NULL").select("__id", "__first")
    )
    components = connected_components(edges).select(F.col("node").alias("__id"), "component")
    least = F.coalesce("component", "__id")
    return members.join(components, "__id", "left").select(
        F.nullif("__id", F.lit(_NULL_ID)).alias(id_col),
        (F.coalesce("__copies", F.lit(1)) - 1 + F.coalesce("__links", F.lit(0))).alias("n_links"),
        F.nullif(least, F.lit(_NULL_ID)).alias("component_id"),
        (least == F.col("__id")).alias("kept"),
    )
