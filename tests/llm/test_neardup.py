"""Near duplicates against all pairs of sets, and components against a plain union."""

import random
import re

import numpy as np
import pytest

from tripmart.llm import neardup
from tripmart.llm.components import connected_components
from tripmart.llm.neardup import near_duplicates, survival

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lowered)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def components(nodes, edges):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def brute(rows, width, percent=80):
    sets = [(i, shingles(t, width)) for i, t in rows]
    edges = []
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                edges.append((i, j))
    found = components({i for i, _ in rows}, edges)
    return sorted((i, len(s), found[i], found[i] == i) for i, s in sets)


def ours(df, width, **more):
    out = near_duplicates(df, width, **more).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out)


@pytest.mark.parametrize("width", [2, 5])
def test_supplied_documents(spark, width):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(3)
    expected = brute([(r.doc_id, r.text) for r in df.collect()], width)
    assert sum(not r[3] for r in expected) > 20
    assert ours(df, width) == expected


def _edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("leaf, block", [(2048, 256), (8, 8)])
def test_many_near_copies_of_one_text(spark, monkeypatch, leaf, block):
    """Small nodes and blocks make the trees branch on and both block joins split."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    rows = [(k, _edited(base, rng, rng.randrange(0, 14))) for k in range(120)]
    rows += [(1000 + k, " ".join(f"v{rng.randrange(400)}" for _ in range(60))) for k in range(150)]
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "BLOCK", block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert ours(df, 2) == brute(rows, 2)


def test_edges(spark):
    rows = [
        (4, "One", "k"),
        (3, "one ", "k"),
        (8, None, "k"),
        (7, "", None),
        (6, " \t\n", "k"),
        (11, "a b c d e f g", "k"),
        (12, "a b c d e f g", "k"),
        (12, "a b c d e f g", "k"),
        (13, "É b", "k"),
        (14, "é b", "k"),
        (20, "long " * 20000, "k"),
        (21, "Long long", "k"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string").repartition(4)
    assert ours(df, 2) == brute([r[:2] for r in rows], 2)
    assert near_duplicates(df.where("false")).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(5, "a b c d"), (5, "p q r s"), (9, "a b c d"), (3, "p q r s"), (None, "p q r s"), (None, "z")]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in out} == {
        (3, 3, True),
        (5, 3, False),
        (9, 3, False),
        (None, 3, False),
    }
    alone = near_duplicates(spark.createDataFrame(rows[-1:], "doc_id long, text string"), 2).first()
    assert alone.doc_id is None and alone.component_id is None and alone.kept


def test_survival_falls_slowly():
    assert survival(0, 0.8) == 1
    assert abs(survival(1, 0.8) - 0.84) < 1e-9
    assert survival(7, 0.8) > 0.4


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(7000, 7000)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(220)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: c for x, c in components(nodes, [e for e in edges if e[0] != e[1]]).items()}


@pytest.mark.parametrize("levels", [3, 6, 7])
def test_recall_when_all_trees_read_the_same_coordinates(levels):
    trees = neardup.trees_needed(levels, 0.8, 0.9999)
    rng = np.random.default_rng(3)
    agree = rng.binomial(neardup.COORDINATES, 0.8, 400_000)
    apart = np.array([(1 - neardup.survival(levels, k / neardup.COORDINATES)) ** trees for k in range(neardup.COORDINATES + 1)])
    assert apart[agree].mean() < 1e-4
    assert neardup.missed(levels, trees, 0.8, 0.9999) <= 1 - 0.9999 < neardup.missed(levels, trees - 1, 0.8, 0.9999)
