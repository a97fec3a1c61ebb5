"""Filter audit against all orders applied one by one to rows of every kind."""

import itertools
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripmart.llm import interactions
from tripmart.llm.interactions import audit_filters, repeated_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(rows):
    out = []
    for i, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            fails.add("E")
        out.append((i, lang or "", fails))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    out, shapley = {}, defaultdict(int)
    documents = failures(rows)
    for part in {p for _, p, _ in documents}:
        own = [(i, f) for i, p, f in documents if p == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, x in enumerate(order):
                here = [(i, f) for i, f in left if x in f]
                failing = [f for _, f in own if x in f]
                left = [(i, f) for i, f in left if x not in f]
                lost = [sum(i in marked for i, _ in here) for marked in (good, toxic)]
                alone = sum(f == {x} for f in failing)
                out[part, "".join(order), step + 1] = [len(left), len(here), len(failing) - len(here), alone, *lost]
                shapley[part, x] += len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def ours(df, labels):
    rows = audit_filters(df, labels).collect()
    got = {(r.part, r.filter_order, r.step): (*(r[c] for c in COUNTS), r.shapley) for r in rows}
    assert len(got) == len(rows)
    return got


def rows():
    many = " ".join(f"w{k}" for k in range(120))
    short, loud, symbol = "Only a few words", "LOUD " * 110, many + " 100% sure | not"
    out = [(1, many, "en"), (2, many, "en"), (3, many, "de"), (3, many, "de"), (None, many, "en"), (4, short, "en")]
    out += [(5, loud, "en"), (6, loud, None), (7, loud, ""), (8, symbol, "en"), (9, None, "en"), (10, "", "de")]
    out += [(11, " \t\n", "en"), (12, "　" * 5, "en"), (13, many + " #", "fr"), (14, "É" * 300, "fr"), (2, short, "en")]
    return [*out, *[(20 + k, many, "en") for k in range(60)], (99, f"{many} {many}", "de"), (0, f"{many} {many}", "de")]


def labels():
    return [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 0), (9, 1, None), (25, None, 1), (26, 1, 1), (777, 1, 1), (None, 1, 1)]


def test_all_orders(spark):
    df = spark.createDataFrame([(*r, 0, "x") for r in rows()], "doc_id long, text string, lang string, part int, own string")
    marks = spark.createDataFrame(labels(), "doc_id long, quality int, toxic int")
    got, want = ours(df.repartition(3), marks), brute(rows(), labels())
    assert got.keys() == want.keys() and len(got) == 600 * 4
    assert got == want
    assert ours(df.where("false"), marks) == {}
    none = ours(df, marks.where("false"))
    assert all(v[4] == v[5] == 0 for v in none.values())


def test_a_removed_copy_still_counts(spark):
    df = spark.createDataFrame([(1, "a $", "en"), (2, "a $", "en")], "doc_id long, text string, lang string")
    got = ours(df, spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int"))
    assert got["en", "DEABC", 1][:3] == (0, 2, 0) and got["en", "DEABC", 2][:3] == (0, 0, 1)
    assert got["en", "EDABC", 1][:2] == (1, 1) and got["en", "EDABC", 1][4] == 1


@pytest.mark.parametrize("groups", [4, 1000])
def test_hot_texts_are_dealt(spark, monkeypatch, groups):
    """A third of all rows share one text, three hold a third of all bytes; the rest are pairs."""
    monkeypatch.setattr(interactions, "GROUPS_A_PARTITION", groups)
    text = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") < 9, F.lit("x" * 40_000))
    rows = spark.range(30_000).select(
        F.col("id").alias("__id"),
        F.lit("en").alias("__part"),
        text.otherwise(F.concat(F.lit("t"), F.expr("id div 6"))).alias("__text"),
    )
    rows = rows.select("*", F.xxhash64("__text").alias("__hash"))
    got = {r[0] for r in repeated_rows(rows).select("__id").collect()}
    first = {}
    want = set()
    for i in range(30_000):
        text = "hot" if i % 3 == 0 else "x" * 40_000 if i < 9 else f"t{i // 6}"
        if first.setdefault(text, i) != i:
            want.add(i)
    assert got == want
