"""Language models against the textbook recursion, and held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import langid
from tripmart.llm.langid import ORDER, fit_words, identify, train


def brute_probability(words, context, char):
    """Interpolated Kneser-Ney by dictionaries."""
    pad = "\x01" * (ORDER - 1)
    counts = [None] * (ORDER + 1)
    counts[ORDER] = Counter()
    for w, n in words.items():
        s = pad + w + "\x02"
        for k in range(ORDER - 1, len(s)):
            counts[ORDER][s[k - ORDER + 1 : k + 1]] += n
    for k in range(ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    p = 1 / langid._ALPHABET
    for k in range(1, ORDER + 1):
        c = counts[k]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        ctx = context[len(context) - k + 1 :]
        after = {g: v for g, v in c.items() if g[:-1] == ctx}
        if after:
            total = sum(after.values())
            p = max(after.get(ctx + char, 0) - d, 0) / total + d * len(after) / total * p
    return p


def test_probabilities():
    words = {"the": 5, "then": 2, "he": 1, "hat": 1, "ten": 2, "été": 1}
    model = fit_words({"a": (list(words), np.array(list(words.values()))), "b": (["zzz"], np.array([3]))})
    for word in ("the", "tha", "été", "qx"):
        codes, _ = langid._codes([word])
        got = np.exp(model.log_probabilities(codes))
        s = "\x01" * (ORDER - 1) + word + "\x02"
        for k in range(len(word) + 1):
            assert got[k, 0] == pytest.approx(brute_probability(words, s[k : k + ORDER - 1], s[k + ORDER - 1]))
            assert got[k, 1] == pytest.approx(brute_probability({"zzz": 3}, s[k : k + ORDER - 1], s[k + ORDER - 1]))


def test_a_context_sums_to_one():
    words = {"the": 5, "then": 2, "he": 1}
    alphabet = [chr(k) for k in range(3, 3 + langid._ALPHABET - 1 - 4)] + ["t", "h", "e", "n", "\x02"]
    alphabet = list(dict.fromkeys(alphabet))
    total = math.fsum(brute_probability(words, "\x01\x01th", c) for c in alphabet)
    assert total < 1.001


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(3)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = train(df.where(~held))
    out = identify(df, model, ("doc_id", "lang")).collect()
    assert len(out) == df.count()
    wrong = [r for r in out if r.lang_pred != r.lang]
    assert len(wrong) < 0.01 * len(out)
    assert sum(r.rejected for r in out) <= 0.005 * len(out)
    assert all(0 <= r.score <= 1 for r in out)
    strange = [(1, "Καλημέρα κόσμε, τι κάνεις σήμερα; " * 5), (2, "漢字仮名交じり文" * 30), (3, "qzxjk vvqzz xkcdw zzqqj " * 20)]
    out = identify(spark.createDataFrame(strange, "doc_id long, text string"), model).collect()
    assert all(r.rejected for r in out)


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 %% 7", "x"), (4, "the the the", "x"), (4, "the the the", "x")]
    rows += [(None, "le la les " * 40000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    train_rows = [(k, t, lang) for k, (t, lang) in enumerate([("the and of", "en"), ("le la les", "fr"), (None, "de"), ("x", None)])]
    labelled = spark.createDataFrame(train_rows, "doc_id long, text string, lang string")
    model = train(labelled, rows_per_language=10**6)
    out = defaultdict(list)
    for r in identify(df, model).collect():
        out[r.doc_id].append((r.lang_pred, r.rejected))
    assert out[1] == out[2] == out[3] == [("und", True)]
    assert set(model.languages) <= {"en", "fr"}
    assert len(out[4]) == 2 and out[4][0] == out[4][1]
    nothing = train(labelled.where("false"))
    assert {r.lang_pred for r in identify(df, nothing).collect()} == {"und"}
    assert identify(df.where("false"), nothing).count() == 0


def test_no_language_is_lost(spark):
    """One whose texts are all longer than the bound, and one of a single row."""
    rng = np.random.default_rng(4)

    def text(letters, n):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(n))

    rows = [(k, text("abcdef", 8000), "long") for k in range(30)] + [(100 + k, text("ghijkl", 40), "short") for k in range(60)]
    rows += [(200, text("mnopqr", 400), "rare"), (201, "12 34", "none"), (202, None, "null")]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_chars=20_000)
    assert model.languages == ["long", "rare", "short"]
    new = [(1, text("abcdef", 60), "long"), (2, text("ghijkl", 60), "short"), (3, text("mnopqr", 60), "rare")]
    got = identify(spark.createDataFrame(new, "doc_id long, text string, lang string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "long", 2: "short", 3: "rare"}


def test_a_small_sample_is_not_calibrated(spark):
    rows = [(k, "some words of it", "en") for k in range(10)]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.usual is None and model.sharpness == 4.0
    got = identify(spark.createDataFrame([(1, "zzz qqq xxx"), (2, "12")], "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.rejected for r in got} == {1: False, 2: True}
