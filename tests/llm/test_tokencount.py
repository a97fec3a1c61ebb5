"""Token counts against a dynamic programme of its own for every word."""

import math
import random
import re

import public_tokenizers
import pytest

from tripmart.llm.tokencount import SPACE, Trie, count_tokens, zipf_scores

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(word, scores, byte_score):
    """(score, tokens) of the best segmentation, over all ends from the left."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        score, n = best[end - 1]
        ways = [(score + width * byte_score, -(n + width))]
        for low in range(end):
            if word[low:end] in scores:
                score, n = best[low]
                ways.append((scores[word[low:end]] + score, -(n + 1)))
        top = max(ways)
        best.append((top[0], -top[1]))
    return best[-1]


def expected(text, scores, byte_score):
    found = [brute(SPACE + w.decode(), scores, byte_score) for w in WORD.findall((text or "").encode())]
    return len(found), sum(n for _, n in found), math.fsum(s for s, _ in found)


def agree(df):
    scores, byte_score = zipf_scores(PATH)
    rows = sorted((r.doc_id, r.text or "") for r in df.collect())
    got = sorted((r.doc_id, r.n_words, r.n_tokens, r.score) for r in count_tokens(df, PATH).collect())
    wanted = sorted((i, *expected(t, scores, byte_score)) for i, t in rows)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    for g, w in zip(got, wanted, strict=True):
        assert g[3] == pytest.approx(w[3], rel=1e-9, abs=1e-9)


def test_supplied_documents(spark):
    agree(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(2))


def test_edges(spark):
    rows = [(1, None, 1), (2, "", 1), (3, " \x0b\n", 1), (4, "naïve 漢字 🙂\x1cx", 1), (5, "the " * 30_000, 1), (5, "same", 1)]
    rows += [(6, "x" * 5000, None), (7, " nbsp", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    agree(df.repartition(3))
    assert count_tokens(df.where("false"), PATH).count() == 0


def test_shared_prefixes_are_scored_once():
    rng = random.Random(7)
    scores = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))): -rng.random() * 9 for _ in range(40)}
    trie = Trie(scores, -4.0)
    inserted = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(500)]
    for w in inserted:
        score, n = brute(w, scores, -4.0)
        assert trie.insert(w) == (n, score)
    assert len(trie.best) == len({w[:k] for w in inserted for k in range(len(w) + 1)})
