"""Packing: an exact round trip, full sequences, and the choice of levels against plain sums of squares."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmart.llm.packing import SumOfSquares, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(df, window=4096):
    tokenizer = Tokenizer.from_file(PATH)
    docs = defaultdict(list)
    for r in df.collect():
        docs[r.doc_id].append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pack(df, PATH, window=window).collect():
        assert r.length == len(r.ids) > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, expected in docs.items():
        if len(expected) == 1:
            got = [x for _, ids, _ in sorted(pieces[i]) for x in ids]
            assert got == expected[0]
            assert {t for _, _, t in pieces[i]} == {len(got)}
        else:
            assert sum(len(ids) for _, ids, _ in pieces[i]) == sum(map(len, expected))
    assert pieces.keys() == docs.keys()
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    return sequences


def test_supplied_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sequences = check(df)
    total = sum(n for s in sequences.values() for _, n in s)
    assert len(sequences) <= total // 4096 + 13


@pytest.mark.parametrize("window", [64, 4096])
def test_edges(spark, window):
    rows = [(1, None), (2, ""), (3, "　 \x85"), (4, "It's <|endoftext|> 12 ÉÀ\x1cx don't"), (5, "the " * 30_000)]
    rows += [(6, "same"), (6, "same"), (7, "a\x0bb c"), (None, "no id")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int").repartition(3)
    check(df, window)
    assert pack(df.where("false"), PATH).count() == 0


def test_words_are_cut_where_the_tokenizer_cuts(spark):
    rng = random.Random(9)
    parts = ["'s", "'", "'ll", "It", "é", "E\u0301", "=\u0338", ".", "***", "—", "9", "12", " ", "\n", "a", "Z", "|", "<|", "|>"]
    parts += ["<|endoftext|>", "<|ENDOFTEXT|>", "-", "_", "ß", "Σ", "漢", "\x00", "\u200b", ",", '"', "&&", "don't"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 30)))) for k in range(400)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), 256)
    plain = [(k, t.replace("<", "")) for k, t in rows]
    check(spark.createDataFrame(plain, "doc_id long, text string").repartition(2), 256)


def test_levels():
    rng = random.Random(1)
    packing = SumOfSquares(32)
    for k in range(400):
        size = rng.randrange(1, 32)
        squares = {}
        for level in range(0, 32 - size + 1):
            if level and not packing.count[level]:
                continue
            after = packing.count.copy()
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] += 1
            squares[level] = int((after**2).sum())
        best = min(squares.values())
        assert packing.place(size) == max(x for x, s in squares.items() if s == best)
        packing.add((k, 0, np.zeros(size, np.uint32)))
        assert [len(x) for x in packing.open] == packing.count.tolist()
