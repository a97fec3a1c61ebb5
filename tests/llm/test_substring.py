"""Substring dedup against a plain dictionary of windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tripmart.llm.substring import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out)


def ours(df, size):
    rows = remove_repeats(df, size).collect()
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in rows)


@pytest.mark.parametrize("size", [13, 50])
def test_supplied_documents(spark, size):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(3)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    expected = brute(rows, size)
    assert sum(r[2] for r in expected) > 0
    assert ours(df, size) == expected


def test_edges(spark):
    passage = " ".join(f"w{k}" for k in range(20))
    rows = [
        (5, f"lead {passage} tail", "x"),
        (2, passage, "x"),
        (9, f"{passage}\n\n{passage}", "x"),
        (9, f"{passage}\n\n{passage}", "x"),
        (9, "another text of the same id", "x"),
        (11, None, "x"),
        (12, "", None),
        (13, "few words", "x"),
        (14, "é x " * 30, "x"),
        (15, "y \x0b" + passage.upper(), "x"),
        (16, ("é x " * 30).strip() + " end", "x"),
        (17, "repeat " * 5000, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string").repartition(4)
    assert ours(df, 13) == brute([r[:2] for r in rows], 13)
    assert remove_repeats(df.where("false")).count() == 0


def test_null_id_comes_last_and_white_space_stays(spark):
    passage = " ".join(f"w{k}" for k in range(15))
    rows = [(None, f"one\n\ttwo {passage}  three\nfour "), (1, passage), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in remove_repeats(df, 13, separator=None).collect()}
    assert out[None].kept_text == "one\n\ttwo three\nfour "
    assert [tuple(s) for s in out[None].spans] == [(2, 17)]
    assert out[1].kept_text == passage and out[2].kept_text is None


def test_hash_of_kept_words(spark):
    df = spark.createDataFrame([(1, " b  a ")], "doc_id long, text string")
    digest = remove_repeats(df).select(F.sha2("kept_text", 256)).first()[0]
    assert digest == hashlib.sha256(b"b a").hexdigest()


@pytest.mark.parametrize("own", [7, None])
def test_rows_of_one_id_with_equal_low_bits_of_their_hashes(spark, own):
    """A row of which another text copies a part loses nothing to a row of its id that only resembles it by hash."""
    rng = random.Random(2)
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(own, " ".join(f"{rng.random():.9f}" for _ in range(25))) for _ in range(800)]
    rows += [(own, f"lead {k} {passage} tail {k}") for k in range(800)]
    df = spark.createDataFrame([(1, passage), *rows], "doc_id long, text string")
    low = df.where("doc_id IS DISTINCT FROM 1").select(F.pmod(F.xxhash64("text"), F.lit(65536)).alias("low"), "text")
    both = low.groupBy("low").agg(F.count_if(F.col("text").startswith("lead")).alias("a"), F.count("*").alias("n"))
    assert both.where("a > 0 AND n > a").count() > 0, "the rows hold such pairs"
    for r in remove_repeats(df, 13, carry=("text",)).where("n_words > 20").collect():
        assert r.n_removed == (20 if r.text.startswith("lead") else 0)
