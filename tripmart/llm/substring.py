"""Substring dedup by seed and extend: repeats of many words are found from winnowed anchors.

*Seed.* Among the word n-grams of every window of ``min_words`` words the one of least hash is the window's
anchor, so equal windows have equal anchors at equal places and neighbouring windows mostly share theirs.
Occurrences of anchors meet by their hash: one shuffle joins the documents, each anchor with the prints of the
windows it stands for (40 bits each, on top of the anchor's own bits), packed in arrays.

*Extend.* From a shared anchor the match is followed to the left and the right as far as the prints of the
windows agree with those of an earlier document. Runs of matching windows that overlap or touch make up a
maximal repeat; its words are removed from all documents but the first that has it.

*Hot passages.* Each chunk of text answers for its own rows first: of the documents of a chunk that share a
window only the first asks the others. What a passage that a third of all documents hold sends to one task is
bounded by the number of chunks, not of documents, and no pairs of documents are ever made.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.wordhash import least_in_window, mix, sequences, text_chunks, words

_PRINT_BYTES = 5
_ANCHOR_BYTES = 3
#: Stands for a null id, which counts as larger than all others.
_NULL_ID = (1 << 63) - 1
#: Text of a chunk that answers for its own rows first.
_CHUNK_BYTES = 2 << 20
#: Text whose anchors make up one bucket, or less.
_BUCKET_BYTES = 8 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")

_PACKED = "__bucket int, __count int, __payload binary, __id long, __mark long, __runs binary"
_FOUND = "__id long, __mark long, __runs binary"


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low bytes of unsigned integers, first all lowest bytes, then all second ones and so on."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(payload: bytes, at: int, count: int, width: int) -> tuple[np.ndarray, int]:
    raw = np.frombuffer(payload, np.uint8, count * width, at).reshape(width, count)
    out = np.zeros((count, 8), dtype=np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8")[:, 0], at + count * width


def _runs(ids: np.ndarray, marks: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(id, mark, runs) per document of matching windows; runs are int32 pairs of first and last window."""
    if not len(ids):
        return
    order = np.lexsort((starts, marks, ids))
    ids, marks, starts = ids[order], marks[order], starts[order]
    document = np.empty(len(ids), dtype=bool)
    document[0] = True
    document[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])
    opens = document.copy()
    opens[1:] |= starts[1:] > starts[:-1] + 1
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(ids)) - 1
    pairs = np.stack([starts[first], starts[last]], axis=1).astype("<i4")
    cuts = np.append(np.flatnonzero(document[first]), len(first))
    for k in range(len(cuts) - 1):
        at = first[cuts[k]]
        yield int(ids[at]), int(marks[at]), pairs[cuts[k] : cuts[k + 1]].tobytes()


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in schema])


_FOUND_SCHEMA = [("__id", pa.int64()), ("__mark", pa.int64()), ("__runs", pa.binary())]
_PACKED_SCHEMA = [
    ("__bucket", pa.int32()),
    ("__count", pa.int32()),
    ("__payload", pa.binary()),
    *_FOUND_SCHEMA,
]


def _seeds(min_words: int, buckets: int):
    anchor_words = max(1, min(min_words // 2, 25)) if min_words != 13 else 5

    def chunk(ids: np.ndarray, marks: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
        found = words(data, bounds)
        n = len(found.hash) - min_words + 1
        if n <= 0:
            return
        row = found.row
        inside = np.flatnonzero(row[:n] == row[min_words - 1 :])
        if not len(inside):
            return
        window = sequences(found.hash, min_words)[inside]
        anchor, place = least_in_window(sequences(found.hash, anchor_words), min_words - anchor_words + 1)
        anchor, place = anchor[inside], place[inside] + inside
        row = row[inside]
        start = inside - found.first_of_row()[row]
        # The first document of the chunk that has a window asks the others; the rest know the answer.
        rank = np.empty(len(ids), dtype=np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        order = np.lexsort((rank[row], window))
        same = window[order]
        opens = np.empty(len(same), dtype=bool)
        opens[0] = True
        opens[1:] = same[1:] != same[:-1]
        leader = ids[row[order[np.flatnonzero(opens)]]][np.cumsum(opens) - 1]
        asks = np.empty(len(same), dtype=bool)
        asks[order] = ids[row[order]] == leader
        known = np.flatnonzero(~asks)
        for i, m, runs in _runs(ids[row[known]], marks[row[known]], start[known]):
            yield int(mix(np.array([i], np.int64).view(np.uint64))[0] % np.uint64(buckets)), 0, None, i, m, runs
        asks = np.flatnonzero(asks)
        # An occurrence: consecutive windows that have the same anchor at the same place.
        place, row, start, anchor, window = place[asks], row[asks], start[asks], anchor[asks], window[asks]
        opens = np.empty(len(asks), dtype=bool)
        opens[0] = True
        opens[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(opens)
        size = np.diff(np.append(first, len(asks)))
        bucket = ((anchor[first] >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((start[first], ids[row[first]], bucket))
        first, size, bucket = first[order], size[order], bucket[order]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        prints = window[np.repeat(first, size) + within]
        ends = np.cumsum(size)
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            f = first[a:b]
            id_ = ids[row[f]]
            payload = b"".join(
                (
                    _planes(np.diff(id_, prepend=0).view(np.uint64), 8),
                    _planes(marks[row[f]].view(np.uint64), 8),
                    _planes(start[f], 4),
                    _planes(size[a:b], 2),
                    _planes(anchor[f], _ANCHOR_BYTES),
                    _planes(prints[ends[a] - size[a] : ends[b - 1]], _PRINT_BYTES),
                )
            )
            yield int(bucket[a]), int(b - a), payload, None, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            for at, to, data, bounds in text_chunks(batch.column(2), _CHUNK_BYTES):
                yield _batch(list(chunk(ids[at:to], marks[at:to], data, bounds)), _PACKED_SCHEMA)

    return run


def _extend(table: pa.Table) -> pa.Table:
    """Windows of one bucket that an earlier document has as well, as runs per document."""
    out, parts = [], []
    n_before = 0
    for bucket, count, payload, id_, mark, runs in zip(*(c.to_pylist() for c in table.columns), strict=True):
        if payload is None:
            out.append((id_, mark, runs))
            continue
        at = 0
        deltas, at = _from_planes(payload, at, count, 8)
        marks, at = _from_planes(payload, at, count, 8)
        start, at = _from_planes(payload, at, count, 4)
        size, at = _from_planes(payload, at, count, 2)
        anchor, at = _from_planes(payload, at, count, _ANCHOR_BYTES)
        size = size.astype(np.int64)
        prints, at = _from_planes(payload, at, int(size.sum()), _PRINT_BYTES)
        ids = np.cumsum(deltas.view(np.int64))
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        key = prints | (np.repeat(anchor, size) << np.uint64(8 * _PRINT_BYTES))
        # Of a window only its occurrence and its place there; ids and marks are those of the occurrence.
        at = np.repeat(np.arange(n_before, n_before + count, dtype=np.int32), size)
        n_before += count
        parts.append((key, at, within.astype(np.int32), ids, marks.view(np.int64), start.astype(np.int64)))
    if parts:
        key, at, within, ids, marks, start = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.argsort(key, kind="stable")
        key = key[order]
        opens = np.empty(len(key), dtype=bool)
        opens[0] = True
        opens[1:] = key[1:] != key[:-1]
        groups = np.flatnonzero(opens)
        own = ids[at[order]]
        least = np.minimum.reduceat(own, groups)[np.cumsum(opens) - 1]
        later = order[own > least]
        within, at = within[later], at[later]
        out.extend(_runs(ids[at], marks[at], start[at] + within))
    return pa.Table.from_batches([_batch(out, _FOUND_SCHEMA)])


def _cover(n_words: int, runs: np.ndarray, min_words: int) -> tuple[list[int], list[int]]:
    """Spans of words, first and one past the last, that the windows cover; overlapping and touching ones are one."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    first, past = runs[:, 0], np.maximum.accumulate(runs[:, 1] + min_words)
    opens = np.empty(len(first), dtype=bool)
    opens[0] = True
    opens[1:] = first[1:] > past[:-1]
    at = np.flatnonzero(opens)
    return first[at].tolist(), np.minimum(past[np.append(at[1:], len(first)) - 1], n_words).tolist()


def _cut(min_words: int, separator: bytes | None, passed: int):
    """Rows with their spans and the text that is left. The last two columns read are the text and the runs."""

    def one(text: str | None, runs: list[bytes] | None) -> tuple:
        if text is None:
            return 0, 0, [], "" if separator is not None else None
        raw = text.encode()
        if not runs:
            if separator is None:
                return len(raw.split()), 0, [], text
            found = raw.split()
            return len(found), 0, [], separator.join(found).decode()
        if separator is None:
            places = [m.span() for m in _WORD.finditer(raw)]
            n = len(places)
        else:
            found = raw.split()
            n = len(found)
        firsts, pasts = _cover(n, np.frombuffer(b"".join(runs), "<i4").reshape(-1, 2).astype(np.int64), min_words)
        spans = [{"first": a, "past": b} for a, b in zip(firsts, pasts, strict=True)]
        kept, at = [], 0
        for a, b in zip([*firsts, n], [*pasts, n], strict=True):
            if separator is not None:
                kept.extend(found[at:a])
            elif at < a:
                kept.append(raw[(0 if at == 0 else places[at][0]) : (places[a][0] if a < n else len(raw))])
            at = b
        text = separator.join(kept) if separator is not None else b"".join(kept)
        return n, sum(b - a for a, b in zip(firsts, pasts, strict=True)), spans, text.decode()

    schema = [
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
        ("kept_text", pa.string()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, _, _ in text_chunks(batch.column(passed)):
                part = batch.slice(at, to - at)
                rows = zip(part.column(passed).to_pylist(), part.column(passed + 1).to_pylist(), strict=True)
                new = _batch([one(text, runs) for text, runs in rows], schema)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:passed], *new.columns], [*part.schema.names[:passed], *new.schema.names]
                )

    return run


def _keys(id_col: str, text_col: str) -> list[Column]:
    """Id with the null replaced, and a hash of the text, which keeps rows of the same id apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("__id"),
        F.xxhash64(text).alias("__mark"),
    ]


def repeated_windows(
    docs: DataFrame, min_words: int = 13, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """``__id``, ``__mark``, ``__runs`` (list of binary): windows of each document that one of smaller id has.

    ``buckets``: anchors are dealt by hash to so many groups, each of which one worker decodes; by default four for
    each shuffle partition, and more where the texts are so long that a bucket would stand for over 8 MB of them.
    """
    spark = docs.sparkSession
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // _BUCKET_BYTES + 1)
    texts = docs.select(*_keys(id_col, text_col), F.col(text_col).cast("string").alias("__text"))
    packed = texts.mapInArrow(_seeds(min_words, buckets), _PACKED)
    found = packed.groupBy("__bucket").applyInArrow(_extend, _FOUND)
    return found.groupBy("__id", "__mark").agg(F.collect_list("__runs").alias("__runs"))


def remove_repeats(
    docs: DataFrame,
    min_words: int = 13,
    separator: str | None = " ",
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Documents without the words that lie in a run of ``min_words`` words which a document of smaller id has.

    Returns ``id_col``, the columns of ``carry``, ``n_words``, ``n_removed``, ``spans`` (maximal repeats: first
    word and one past the last, from 0) and ``kept_text``, one row per row of ``docs``. Kept words are joined by
    ``separator``; with None the text keeps its own white space, less the removed words and what follows them.

    Defined cases: a null text has no words (kept text empty, or null if ``separator`` is None); a text of fewer
    than ``min_words`` words is kept whole; repeats inside one document stay; rows of equal id never remove each
    other's words; a null id counts as larger than all ids; an empty table gives an empty result.
    """
    runs = repeated_windows(docs, min_words, id_col, text_col)
    passed = [f"__p{k}" for k in range(len(carry) + 1)]
    left = docs.select(
        *_keys(id_col, text_col),
        *[F.col(c).alias(p) for c, p in zip((id_col, *carry), passed, strict=True)],
        F.col(text_col).cast("string").alias("__text"),
    )
    joined = left.join(runs, ["__id", "__mark"], "left").select(*passed, "__text", "__runs")
    kinds = ", ".join(f"{p} {joined.schema[p].dataType.simpleString()}" for p in passed)
    out = f"{kinds}, n_words long, n_removed long, spans array<struct<first: long, past: long>>, kept_text string"
    cut = joined.mapInArrow(_cut(min_words, None if separator is None else separator.encode(), len(passed)), out)
    return cut.select(
        *[F.col(p).alias(c) for c, p in zip((id_col, *carry), passed, strict=True)],
        "n_words",
        "n_removed",
        "spans",
        "kept_text",
    )
