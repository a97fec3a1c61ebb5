"""Token ids in Parquet files that can be read in part.

A token file holds a row per document, in ascending id order: ``doc_id``, ``part`` (number of the file's range of
ids), ``local_start`` (ids of earlier documents of that part), ``n_tokens`` and the list column ``ids`` (int32).
Small pages with column and offset indexes let a reader fetch single documents, and the metadata without any ids.
Two encodings of the ids: *dictionary* (bit-packed places in a dictionary per row group, small where few distinct
ids occur) and *delta* (differences, bit-packed in blocks; no dictionary has to be read before a page).

Where a part begins in the whole stream is known only when all parts are counted, so it is kept beside the data,
a row per part. Documents are sorted by one range shuffle of their texts; a range holds at most what one task
should, whatever the ids are. Texts are encoded segment by segment: a worker process remembers the ids of the
segments it has met and gives only new ones to the tokenizer.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm.wordhash import span_hashes, text_chunks

ENCODINGS = ("dictionary", "delta")
#: Row group and page size, in bytes before compression, and rows of a page.
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 256

DATA, PARTS = "data", "parts"

#: Ids that a task remembers for segments it has met, and segments given to the tokenizer at once.
_KNOWN_IDS = 3_000_000
_AT_ONCE = 4096
_JOINED = 128

# Bytes after and before which a single space surely begins a new piece: all but white space, and but the bytes of
# characters that may be white space (their first byte is one of these four).
_SOLID = np.ones(256, dtype=bool)
_SOLID[:33] = False
_SOLID[127] = False
_MAYBE_SPACE = {0xC2: 2, 0xE1: 3, 0xE2: 3, 0xE3: 3}

# Kinds of bytes between which a new piece begins: letters, digits, other ASCII characters. What follows an apostrophe
# may belong to it, and the bar is part of special tokens.
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[33:127] = 4
_KINDS[list(map(ord, string.ascii_letters))] = 1
_KINDS[48:58] = 2
_KINDS[ord("|")] = 0


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of spans that cover all bytes and can be encoded one by one by a byte-level tokenizer.

    Such a tokenizer cuts before a space that stands alone between two other characters, on both sides of a
    line feed that does, and between ASCII characters of two kinds, but for what follows an apostrophe. Nothing it
    does looks past those places.
    """
    n = len(data)
    solid = _SOLID[data]
    for first, size in _MAYBE_SPACE.items():
        at = np.flatnonzero(data == first)
        for k in range(size):
            solid[np.minimum(at + k, n - 1)] = False
    opens = np.zeros(n, dtype=bool)
    single = np.zeros(n, dtype=bool)
    single[1:-1] = solid[:-2] & solid[2:]
    opens |= single & (data == 32)
    feed = np.flatnonzero(single & (data == 10))
    opens[feed] = True
    opens[feed + 1] = True
    kind = _KINDS[data]
    differ = (kind[1:] != kind[:-1]) & (kind[1:] != 0) & (kind[:-1] != 0) & (data[:-1] != 39)
    opens[1:] |= differ
    # A row's first and last byte have no neighbour in it; the first opens a span in any case.
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (data[edges - 1] <= 32)]
    opens[edges - 1] = False
    opens[bounds[:-1][bounds[:-1] < n]] = True
    start = np.flatnonzero(opens)
    end = np.append(start[1:], n)
    return np.searchsorted(bounds, start, side="right") - 1, start, end


class SegmentEncoder:
    """Ids of the rows of a chunk, for a byte-level tokenizer without normalisation."""

    def __init__(self, path: str):
        # One thread for a task: Spark counts on it, and each further thread keeps memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        # A byte-level vocabulary spells each byte by one character.
        self.n_bytes[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _encode(self, texts: list[str], at_once: int) -> Iterator[np.ndarray]:
        for low in range(0, len(texts), at_once):
            for x in self.tokenizer.encode_batch_fast(texts[low : low + at_once], add_special_tokens=False):
                yield np.array(x.ids, dtype=np.int32)

    def _encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of segments of a space and more that is no white space, many in one call.

        Laid end to end they are cut where they begin, and the bytes that ids stand for tell where that is.
        """
        joined = ["".join(texts[k : k + _JOINED]) for k in range(0, len(texts), _JOINED)]
        ids = np.concatenate([np.zeros(0, np.int32), *self._encode(joined, _AT_ONCE // _JOINED)])
        reached = np.cumsum(self.n_bytes[ids])
        past = np.searchsorted(reached, np.cumsum([len(x.encode()) for x in texts])) + 1 if texts else reached
        return ids, np.diff(past, prepend=0)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        plain = np.array([x[0] == " " and not (x[1:2] or " ").isspace() and not x[-1].isspace() for x in texts])
        order = np.argsort(~plain, kind="stable")
        texts = [texts[k] for k in order]
        n = int(plain.sum())
        words, size = self._encode_words(texts[:n])
        rest = list(self._encode(texts[n:], _AT_ONCE))
        size = np.concatenate([size, np.array([len(x) for x in rest], dtype=np.int64)])
        first = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, words, *rest])
        every = np.concatenate([self.keys, keys[order]])
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.first = np.concatenate([self.first, first])[order]
        self.size = np.concatenate([self.size, size])[order]

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, number of ids of each row)."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(bounds) - 1, np.int64)
        row, start, end = segments(data, bounds)
        kinds, where, place = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.ids) > _KNOWN_IDS:
            self._forget()
        new = np.ones(len(kinds), dtype=bool)
        if len(self.keys):
            new = self.keys[np.minimum(np.searchsorted(self.keys, kinds), len(self.keys) - 1)] != kinds
        if new.any():
            raw = data.tobytes()
            spans = zip(start[where[new]].tolist(), end[where[new]].tolist(), strict=True)
            self._learn(kinds[new], [raw[a:b].decode() for a, b in spans])
        at = np.searchsorted(self.keys, kinds)[place]
        size = self.size[at]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        ids = self.ids[np.repeat(self.first[at], size) + within]
        return ids, np.bincount(row, weights=size, minlength=len(bounds) - 1).astype(np.int64)


@lru_cache(maxsize=1)
def _encoder(path: str) -> SegmentEncoder:
    """One encoder for all tasks of a worker process, so common segments are encoded once."""
    return SegmentEncoder(path)


def _with_end(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each row."""
    ends = np.cumsum(count)
    out = np.insert(ids, ends, np.int32(end_id))
    return out, count + 1


_ROWS = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"


def _encode(tokenizer: str, end_id: int):
    """Rows (id, text) in order to rows of ``_ROWS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        part = TaskContext.get().partitionId()
        before = 0
        for batch in batches:
            for at, to, data, bounds in text_chunks(batch.column(1)):
                ids, count = _with_end(*encode(data, bounds), end_id)
                ends = np.cumsum(count)
                columns = [
                    batch.column(0).slice(at, to - at),
                    pa.array(np.full(to - at, part, dtype=np.int32)),
                    pa.array(before + ends - count),
                    pa.array(count.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)),
                ]
                before += int(ends[-1])
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "local_start", "n_tokens", "ids"])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    encoding: str = "dictionary",
    id_col: str = "doc_id",
    text_col: str = "text",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Encode each text, end it with ``end_id``, and write token files of all documents in ascending id order.

    ``tokenizer``: path of a file of the tokenizers library with a byte-level tokenizer; all executors have it.
    ``encoding``: one of :data:`ENCODINGS`, for the ids; the other columns are small and take delta encoding where
    no dictionary pays.

    Defined cases: a null or empty text is its end id alone; a null id comes after all others; rows of equal id
    lie side by side, ordered by a hash of the text; an empty table gives files without rows; extra columns are
    left out. ``path`` must be new.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    order: list[Column] = [F.col("__id").isNull(), F.col("__id"), F.xxhash64("__text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = ranged.mapInArrow(_encode(tokenizer, end_id), _ROWS)
    writer = encoded.write.option("parquet.writer.version", "v2").option("parquet.block.size", str(row_group_bytes))
    writer = writer.option("parquet.page.size", str(page_bytes)).option("parquet.page.row.count.limit", str(page_rows))
    # Lists of ids are checked for size after few rows: one row may hold thousands of ids.
    writer = writer.option("parquet.page.size.row.check.min", "10").option("parquet.block.size.row.check.min", "10")
    dictionary = str(encoding == "dictionary").lower()
    writer.option("parquet.enable.dictionary", dictionary).parquet(f"{path}/{DATA}")

    spark = docs.sparkSession
    data = spark.read.schema(_ROWS).parquet(f"{path}/{DATA}")
    totals = data.groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_part_tokens"))
    # A row per part: the number of tasks that wrote, not of documents.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_part_tokens").over(earlier), F.lit(0)).alias("base")
    totals.select("part", "n_docs", "n_part_tokens", base).coalesce(1).write.parquet(f"{path}/{PARTS}")


_PARTS = "part int, n_docs long, n_part_tokens long, base long"


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``n_tokens``; no page of ids is read."""
    return _read(spark, path).drop("ids")


def read_tokens(
    spark: SparkSession,
    path: str,
    first_id: int | None = None,
    last_id: int | None = None,
    first: int | None = None,
    past: int | None = None,
) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` of all documents, or of a selection.

    ``first_id`` to ``last_id`` (inclusive) selects documents; ``first`` to ``past`` (exclusive) those that hold ids
    of that stretch of the whole stream. Both reach the scan, where the statistics of row groups and the page
    index leave out what they can't match.
    """
    return _read(spark, path, first_id, last_id, first, past)


def _read(spark, path, first_id=None, last_id=None, first=None, past=None) -> DataFrame:
    data = spark.read.schema(_ROWS).parquet(f"{path}/{DATA}")
    parts = spark.read.schema(_PARTS).parquet(f"{path}/{PARTS}")
    if first_id is not None:
        data = data.where(F.col("doc_id") >= first_id)
    if last_id is not None:
        data = data.where(F.col("doc_id") <= last_id)
    if first is not None or past is not None:
        hit = F.lit(True)
        if first is not None:
            hit &= F.col("base") + F.col("n_part_tokens") > first
        if past is not None:
            hit &= F.col("base") < past
        # Two numbers: the parts that the stretch touches, as literals for the statistics of the files.
        low, high = parts.where(hit).agg(F.min("part"), F.max("part")).first()
        data = data.where(F.lit(False) if low is None else F.col("part").between(low, high))
    out = data.join(parts.select("part", "base"), "part")
    out = out.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")
    if first is not None:
        out = out.where(F.col("start") + F.col("n_tokens") > first)
    return out if past is None else out.where(F.col("start") < past)


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` (of the ids as little-endian 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            ends = 4 * lists.offsets.to_numpy().astype(np.int64)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    rows = tokens.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
