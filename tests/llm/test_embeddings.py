"""Vector near-duplicates against all cosines."""

import math

import numpy as np
import pandas as pd
import pytest

from tests.llm.test_neardup import components
from tripmart.llm import embeddings
from tripmart.llm.embeddings import most_differing, near_vectors, plan_tables


def brute(rows, threshold=0.9):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, dtype=float)
        x = x / np.abs(x).max()
        return x / np.sqrt((x * x).sum())

    units = [(i, unit(v)) for i, v in rows]
    links, edges = [0] * len(rows), []
    for n, (i, a) in enumerate(units):
        for m in range(n):
            j, b = units[m]
            if a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold:
                links[n] += 1
                links[m] += 1
                edges.append((i, j))
    found = components({i for i, _ in rows}, edges)
    return sorted((i, links[n], found[i], found[i] == i) for n, (i, _) in enumerate(rows))


def ours(df, **more):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df, **more).collect())


def test_supplied_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").repartition(3)
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert ours(df) == brute(rows)
    # No two of the small table are near; near copies of every fifth are added.
    rng = np.random.default_rng(4)
    rows += [(1000 + i, (np.array(v) + 0.04 * rng.standard_normal(len(v))).tolist()) for i, v in rows[::5]]
    expected = brute(rows)
    assert sum(r[1] for r in expected) > 100
    assert ours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == expected


@pytest.mark.parametrize(("block", "sketch_block"), [(1024, 8192), (32, 8192), (32, 16)])
def test_a_crowd_and_its_blocks(spark, monkeypatch, block, sketch_block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "SKETCH_BLOCK", sketch_block)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(24)
    rows = [(k, (centre + 0.3 * rng.standard_normal(24)).tolist()) for k in range(150)]
    rows += [(k, rng.standard_normal(24).tolist()) for k in range(200, 320)]
    rows += [(k, centre.tolist()) for k in range(400, 440)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert ours(df, recall=0.999999) == brute(rows)


def test_edges(spark):
    rows = [
        (9, [1.0, 0.0]),
        (4, [2.0, 0.0]),
        (4, [2.0, 0.0]),
        (5, [0.0, 0.0]),
        (6, None),
        (7, [1.0, None]),
        (8, [float("nan"), 1.0]),
        (10, [float("inf"), 1.0]),
        (11, []),
        (12, [1.0, 0.0, 0.0]),
        (13, [-0.0, 1.0]),
        (14, [0.0, 1.0]),
        (15, [1e300, 1e299]),
        (16, [1e-300, 1e-301]),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, __id int").repartition(3)
    assert ours(df, recall=0.999999) == brute(rows)
    assert near_vectors(df.where("false")).count() == 0
    none = spark.createDataFrame([(None, [1.0]), (3, [2.0])], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in near_vectors(none).collect()} == {(None, 1, 3, False), (3, 1, 3, True)}


def test_tables_and_sketches_reach_the_recall():
    apart = math.acos(0.9) / math.pi
    signs = 64 * embeddings.SKETCH_WORDS
    for recall in (0.9, 0.999, 0.999999):
        most = most_differing(0.9, recall)
        sifted = sum(math.comb(signs, k) * apart**k * (1 - apart) ** (signs - k) for k in range(most + 1, signs + 1))
        for n in (10, 10**4, 10**7):
            bits, tables = plan_tables(n, 0.9, recall)
            assert (1 - (1 - apart) ** bits) ** tables + sifted <= 1 - recall + 1e-12


@pytest.mark.parametrize("pairs", [500, 4000, 24_000])
def test_planted_pairs_are_found(spark, pairs):
    """Pairs of cosine 0.9 and a little more, among vectors that are unlike all others."""
    rng = np.random.default_rng(pairs)
    a = rng.standard_normal((pairs, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((pairs, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = 0.9000001
    b = cosine * a + math.sqrt(1 - cosine**2) * b
    frame = pd.DataFrame({"vec_id": np.arange(2 * pairs), "embedding": [x.tolist() for x in np.concatenate([a, b])]})
    found = near_vectors(spark.createDataFrame(frame), recall=0.99).where("n_links > 0").select("vec_id", "component_id")
    found = found.toPandas()
    second = found[found.vec_id >= pairs]
    assert (second.vec_id - pairs == second.component_id).mean() > 0.999
    assert len(second) >= 0.99 * pairs - 3 * math.sqrt(0.01 * pairs)
