"""The pipeline against plain versions of its stages, and planted cases."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm.test_neardup import brute as brute_near
from tests.llm.test_packing import PATH, Tokenizer
from tests.llm.test_substring import brute as brute_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def _word(rng, syllables):
    return "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    tongues = {"en": ["the", "ing", "er", "th", "sh", "wh"], "es": ["que", "ción", "os", "ado", "ñ", "ez"]}
    docs = []
    for k in range(240):
        lang = "en" if k % 2 else "es"
        docs.append([k, " ".join(_word(rng, tongues[lang]) for _ in range(120)), lang])
    passage = " ".join(_word(rng, tongues["en"]) for _ in range(60))
    item = " ".join(_word(rng, tongues["en"]) for _ in range(30))
    docs[31][1] += "\n" + passage
    docs[33][1] = passage + "\n " + docs[33][1]
    docs[51][1] = docs[51][1][:200] + " " + item + " " + docs[51][1][200:]
    docs.append([300, docs[7][1], "en"])
    words = docs[9][1].split()
    words[40] = "changed"
    docs.append([301, " ".join(words), "en"])
    docs += [[302, "123 456", "en"], [303, None, "en"], [304, "", None], [305, "漢字仮名交じり文" * 40, None]]
    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in docs]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "too short")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {r[0]: r for r in rows}


def test_planted_cases(spark, tables):
    path, rows = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = [set(rows)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.dtypes == docs.dtypes
        left = {r.doc_id: r for r in out.collect()}
        seen.append(set(left))
        docs = spark.createDataFrame(list(left.values()), SCHEMA)
        if name == "substring_dedup":
            assert left[31].text == rows[31][1]
            assert left[33].text == rows[33][1][rows[33][1].index("\n") + 2 :]
            assert left[33].n_chars == len(left[33].text)
            assert all(r.text == rows[i][1] for i, r in left.items() if i != 33)
    dropped = [a - b for a, b in zip(seen, seen[1:], strict=False)]
    assert dropped == [{302, 303, 304, 305}, {300, 301}, set(), {51}]


def test_stages_against_plain_versions(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    near = {r.doc_id for r in STAGES["near_dedup"](spark, docs, sf_dir).collect()}
    assert near == {i for i, _, _, kept in brute_near(list(rows.items()), 5) if kept}
    cut = {r.doc_id: r.text for r in STAGES["substring_dedup"](spark, docs, sf_dir).collect()}
    expected = {i: (n, gone, kept) for i, n, gone, kept in brute_repeats(list(rows.items()), 50)}
    assert cut.keys() == {i for i, (n, gone, _) in expected.items() if not gone or gone < n}
    assert all(t.encode().split() == expected[i][2].encode().split() for i, t in cut.items())


def test_run(spark, tables):
    path, _ = tables
    out = corpus_pipeline.run(spark, path)
    total = out.agg(F.sum("length")).first()[0]
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), SCHEMA)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert total == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(texts)


def test_rows_of_null_and_repeated_ids_stand_for_themselves(spark, tmp_path):
    rng = random.Random(5)
    a, b, c, d, e = (" ".join(_word(rng, ["the", "ing", "er", "th", "sh", "wh"]) for _ in range(60)) for _ in range(5))
    item = " ".join(f"item{k}" for k in range(20))
    # Rows of one id copy documents 7 and 8, which are not alike; others of that id are clean.
    rows = [(7, a), (8, b), (9, a), (9, b), (9, c), (None, a), (None, b), (None, d), (None, d), (12, e), (12, e), (5, c)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(4)
    left = STAGES["near_dedup"](spark, df, str(tmp_path))
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(7, a), (8, b), (0, d), (12, e), (5, c)])

    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, a), (None, f"{b} {item}"), (3, c), (3, f"{item} {d}"), (4, item), (5, e)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(4)
    left = STAGES["benchmark_decontamination"](spark, df, str(tmp_path))
    assert {(r.doc_id, r.text) for r in left.collect()} == {(None, a), (3, c), (5, e)}


def _write(spark, path, rows, schema=SCHEMA, items=()):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_empty_tables(spark, tmp_path):
    got = corpus_pipeline.run(spark, _write(spark, str(tmp_path), []))
    assert got.count() == 0 and "sequence_id" in got.columns


def test_long_texts_and_columns_of_clashing_names(spark, tmp_path):
    """Texts of a hundred thousand words beside short ones; columns that stages use themselves; copies of a row."""
    rng = random.Random(12)
    tongues = ["the", "ing", "er", "th", "sh", "wh"]
    texts = [" ".join(_word(rng, tongues) for _ in range(n)) for n in (100_000, 150, 150, 60, 150)]
    rows = [(k, t, "en", "s", len(t), 7, "x") for k, t in enumerate(texts)]
    rows += [rows[1], (9, texts[2], "en", "s", len(texts[2]), 8, "y")]
    path = _write(spark, str(tmp_path), rows, f"{SCHEMA}, __row long, component_id string", [(1, texts[3])])
    got = corpus_pipeline.run(spark, path).collect()
    tokenizer = Tokenizer.from_file(PATH)
    for k, t in enumerate(texts):
        pieces = [r for r in got if r.doc_id == k]
        want = 0 if k == 3 else len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
        assert sum(r.length for r in pieces) == want, k
    assert not [r for r in got if r.doc_id == 9]
