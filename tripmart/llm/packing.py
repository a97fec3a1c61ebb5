"""Sum-of-squares online packing of documents into windows of a fixed number of tokens.

A document's whole windows are cut off first; each is a sequence of its own. The rest goes to the fill level
that leaves the least sum of squared numbers of open windows over all levels, read from an array of levels: one
more window at the level it reaches, one less at the level it leaves, none where the window gets full. Ties go
to the fullest level.

Every task packs its own documents, so nothing is shuffled. What stays open at its end is packed once more with
cuts: pieces are laid end to end, so all windows are full but one, and that one is cut at powers of two, which
need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tokens import WordEncoder
from tripmart.llm.wordhash import text_chunks

#: Windows that a task holds open at most; beyond, all of them are packed once more and closed.
MOST_OPEN = 20_000

#: Document, first id in it, ids. Documents are numbered by the caller.
Piece = tuple[int, int, np.ndarray]


class SumOfSquares:
    """Open windows by fill level."""

    def __init__(self, window: int = 4096):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def place(self, size: int) -> int:
        """Level to which ``size`` ids, fewer than a window, go; 0 is a new window."""
        levels = np.arange(self.window - size + 1)
        left = np.where(levels > 0, 1 - 2 * self.count[: len(levels)], 0)
        reached = 2 * self.count[size : self.window + 1] + 1
        reached[-1] = 0
        change = (left + reached).astype(np.float64)
        change[1:][self.count[1 : len(levels)] == 0] = np.inf
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def add(self, piece: Piece) -> list[Piece] | None:
        """Put a piece into a window; the window, if it is full now."""
        size = len(piece[2])
        level = self.place(size)
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.open[level + size].append(pieces)
        self.count[level + size] += 1
        self.n_open += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """Lay all open windows, the fullest first, end to end; cut what is left at powers of two."""
        pieces = [p for level in reversed(self.open) for pack in level for p in pack]
        left = sum(len(p[2]) for p in pieces)
        self.__init__(self.window)
        now: list[Piece] = []
        room = target = self._next(left)
        for document, start, ids in pieces:
            at = 0
            while at < len(ids):
                part = ids[at : at + room]
                now.append((document, start + at, part))
                at += len(part)
                room -= len(part)
                left -= len(part)
                if not room:
                    yield now
                    now = []
                    room = target = self._next(left)
        assert not now and not target

    def _next(self, left: int) -> int:
        """Size of the next sequence: a whole window, or the largest power of two."""
        if left >= self.window:
            return self.window
        return 1 << (left.bit_length() - 1) if left else 0


_OUT = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("ids", pa.list_(pa.int64())),
]


def _pack(tokenizer: str, end_id: int, window: int, with_ids: bool):
    kinds = _OUT if with_ids else _OUT[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(tokenizer)
        packing = SumOfSquares(window)
        base = TaskContext.get().partitionId() << 40
        n_sequences = 0
        # What documents with ids in open windows need for their rows.
        passed: dict[int, tuple] = {}
        waiting: dict[int, int] = {}
        out: list[tuple] = []
        schema: list[str] = []
        types: list[pa.DataType] = []

        def write(pieces: list[Piece]) -> None:
            nonlocal n_sequences
            at = 0
            for document, start, ids in pieces:
                row, total = passed[document]
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                own = (start, len(ids), crc, total, base + n_sequences, at)
                out.append((*row, *own, ids.tolist()) if with_ids else (*row, *own))
                at += len(ids)
                waiting[document] -= len(ids)
                if not waiting[document]:
                    del waiting[document], passed[document]
            n_sequences += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, [*types, *(t for _, t in kinds)], strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, [*schema, *(n for n, _ in kinds)])

        number = 0
        for batch in batches:
            schema, types = batch.schema.names[:-1], batch.schema.types[:-1]
            for at, to, data, bounds in text_chunks(batch.column(batch.num_columns - 1)):
                rows = list(zip(*(c.slice(at, to - at).to_pylist() for c in batch.columns[:-1]), strict=True))
                ids, count = encode(data, bounds)
                ends = np.cumsum(count)
                for k in range(to - at):
                    own = np.append(ids[ends[k] - count[k] : ends[k]], np.uint32(end_id))
                    passed[number], waiting[number] = (rows[k], len(own)), len(own)
                    whole = len(own) // window * window
                    for low in range(0, whole, window):
                        write([(number, low, own[low : low + window])])
                    if whole < len(own) and (full := packing.add((number, whole, own[whole:].copy()))):
                        write(full)
                    number += 1
                if packing.n_open > MOST_OPEN:
                    for pieces in packing.close():
                        write(pieces)
                if out:
                    yield flush()
        for pieces in packing.close():
            write(pieces)
        if out:
            yield flush()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    window: int = 4096,
    with_ids: bool = True,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """A row per piece: the columns ``keep``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and, if ``with_ids``, the ids.

    ``tokenizer``: path of a file of the tokenizers library whose tokenizer drops white space; all executors
    have it. ``end_id`` follows each document. ``window`` must be a power of two. Each sequence has ``window``
    ids, or a smaller power of two: less than one such set of sequences per task or ``MOST_OPEN`` windows.

    Defined cases: a null or empty text is its end id alone; repeated rows are packed each; a text longer than a
    window is cut; extra columns are left out; an empty table gives no rows. Sequence ids hold the number of
    the task's partition, so a task that runs again after a lost executor gives the same rows.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    names = [f"__p{k}" for k in range(len(keep))]
    rows = docs.select(
        *[F.col(c).alias(p) for c, p in zip(keep, names, strict=True)], F.col(text_col).cast("string").alias("__text")
    )
    kinds = "".join(f"{p} {rows.schema[p].dataType.simpleString()}, " for p in names)
    out = kinds + "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = rows.mapInArrow(_pack(tokenizer, end_id, window, with_ids), out + ", ids array<long>" * with_ids)
    return packed.withColumnsRenamed(dict(zip(names, keep, strict=True)))
