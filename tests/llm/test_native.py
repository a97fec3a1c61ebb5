"""Chat formatting, decontamination and licence scans against plain versions, with edge cases."""

import random
import re
import textwrap
import unicodedata

import pytest

from tripmart.llm import chat
from tripmart.llm.chat import collapse_snapshots, render_chats
from tripmart.llm.decontaminate import contained_items, decontaminate, size_class
from tripmart.llm.licenses import TEMPLATES, TEXTS, scan_licenses, template_bigrams


def words(text):
    out, now = [], ""
    for c in (text or "").lower() + " ":
        if unicodedata.category(c)[0] in "LMN":
            now += c
        elif now:
            out.append(now)
            now = ""
    return out


TURNS = "conv_id long, turn long, role string, text string, part string"


def talk(i, *said):
    return [(i, k, "user" if k % 2 == 0 else "assistant", t, "x") for k, t in enumerate(said)]


@pytest.mark.parametrize("size", [1024, 2])
def test_snapshots(spark, monkeypatch, size):
    monkeypatch.setattr(chat, "SLICE", size)
    rows = talk(5, "a", "b") + talk(6, "a", "b", "c") + talk(7, "a", "b", "c") + talk(8, "a", "x") + talk(9, "b")
    rows += talk(10, "a") + talk(11, None, "") + talk(12, "", "") + talk(12, "", "") + talk(13, "a", "b", "c", "d", "e")
    rows += [(14, 3, "user", "late", "x"), (14, None, "user", "last", "x"), (None, 0, None, "no id", "x")]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    got = {(r.conv_id, r.n_turns, r.n_copies) for r in collapse_snapshots(df).collect()}
    assert got == {(8, 2, 1), (9, 1, 1), (11, 2, 1), (12, 2, 1), (13, 5, 1), (14, 2, 1), (None, 1, 1)}
    parts = sorted(render_chats(df).where("conv_id = 13").collect(), key=lambda r: r.part)
    assert "".join(r.chat for r in parts) == "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n<|assistant|>\nd\n<|user|>\ne\n"
    assert len(parts) == (1 if size == 1024 else 3)
    assert render_chats(df.where("false")).count() == 0


def test_copies_and_a_hot_opening(spark):
    rows = [r for i in range(300) for r in talk(i, "hello", f"reply {i % 3}")] + talk(900, "hello", "reply 0", "more")
    got = {(r.conv_id, r.n_turns, r.n_copies) for r in collapse_snapshots(spark.createDataFrame(rows, TURNS)).collect()}
    assert got == {(900, 3, 1), (1, 2, 100), (2, 2, 100)}


def brute_items(docs, items, n=5, threshold=0.8):
    def shingles(w):
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}

    classes = {}
    for i, t in items:
        w = tuple(words(t))
        if len(w) >= n:
            classes[w] = min(i, classes.get(w, i))
    found = {}
    for d, t in docs:
        own = shingles(words(t))
        for w, i in classes.items():
            s = shingles(list(w))
            if len(s & own) >= threshold * len(s) - 1e-9:
                found[d, i] = max(found.get((d, i), 0), len(s & own))
    return {(d, i, n) for (d, i), n in found.items()}


def test_items_in_documents(spark):
    item = "the quick brown fox jumps over the lazy dog and runs far away from all of them"
    halves = item.split()
    items = [(1, item), (2, item.upper() + "!"), (3, "too few words"), (4, None), (5, ""), (6, "one two three four five")]
    filler = " ".join(f"f{k}" for k in range(3000))
    docs = [
        (10, f"{filler} {item} {filler}", 1),
        (11, f"{filler} {' '.join(halves[:9])} {filler} {' '.join(halves[5:])}", 1),
        (12, item.replace("lazy", "eager"), 1),
        (13, item.replace("fox", "cat").replace("away", "off"), 1),
        (14, "One, two; three?\nfour -- five", 1),
        (15, None, 1),
        (16, "", 1),
        (17, item, 1),
        (17, item, 1),
        (17, "another text", 1),
        (18, "one two three four", 1),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shared) for r in contained_items(df, bench).collect()}
    assert got == brute_items([d[:2] for d in docs], items)
    assert (10, 1, 13) in got and (14, 6, 1) in got
    left = sorted(r.doc_id for r in decontaminate(df, bench).collect())
    assert left == sorted(d[0] for d in docs if d[0] not in {x[0] for x in got})
    assert contained_items(df.where("false"), bench).count() == 0
    assert contained_items(df, bench.where("false")).count() == 0
    assert decontaminate(df, bench.where("false")).count() == len(docs)


def test_null_ids(spark):
    item = "a b c d e f g h"
    df = spark.createDataFrame([(None, item), (3, "x")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert [tuple(r) for r in contained_items(df, bench).collect()] == [(None, None, 4, 4, 1.0)]
    assert [r.doc_id for r in decontaminate(df, bench).collect()] == [3]


def test_large_benchmarks_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("tripmart.llm.decontaminate.BROADCAST_ROWS", 0)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id, r.n_shared) for r in contained_items(df, bench).collect()}
    assert got == brute_items([(r.doc_id, r.text) for r in df.collect()], [(r.item_id, r.text) for r in bench.collect()])


def brute_licenses(docs, threshold=0.8):
    out = {}
    for i, t in docs:
        t = t or ""
        units = set(t.split("\n")) | set(re.sub(r"([.!?;])\s+", r"\1\n", t).split("\n")) | set(re.split(r"\n\s*\n", t))
        for unit, templates in [*((unit, TEMPLATES) for unit in units), (t, TEXTS)]:
            w = words(unit)
            own = frozenset(zip(w, w[1:], strict=False))
            for name, template in templates:
                other = {tuple(x.split()) for x in template_bigrams(template)}
                if own and 2 * len(own & other) / (len(own) + len(other)) >= threshold:
                    dice, found = out.get((i, name), (0, set()))
                    out[i, name] = (max(dice, 2 * len(own & other) / (len(own) + len(other))), found | {own})
    return {(i, name, dice, len(found)) for (i, name), (dice, found) in out.items()}


def test_licenses(spark):
    docs = [
        (1, "Text.\nReleased under the MIT License.", "x"),
        (2, "some words. Released under the MIT license! more words follow here", "x"),
        (3, TEMPLATES[14][1].replace(" a copy", "\na copy") + "\n\nOther text.", "x"),
        (4, "Licensed under the Apache License", "x"),
        (5, "all rights reserved\nAll Rights Reserved.\nlicensed under cc-by-nc 4.0", "x"),
        (6, None, "x"),
        (7, "", "x"),
        (8, "MIT", "x"),
        (9, "Released under the MIT License.", "x"),
        (9, "Released under the MIT License.", "x"),
        (10, "word " * 20_000 + "\nThis work is licensed under the GNU General Public License, version 3.", "x"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, license string").repartition(3)
    got = {(r.doc_id, r.license, r.dice, r.n_matches) for r in scan_licenses(df).collect()}
    assert got == brute_licenses([d[:2] for d in docs])
    assert {x[0] for x in got} >= {1, 2, 3, 5, 9, 10} and not {x[0] for x in got} & {6, 7, 8}
    assert scan_licenses(df.where("false")).count() == 0
    null = scan_licenses(spark.createDataFrame([(None, "All rights reserved.")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license) for r in null] == [(None, "Proprietary")]


def test_whole_licence_texts(spark):
    whole = dict(TEXTS)
    head = "The Licence\n\nCopyright (c) 2020 Some Holder\n\n"
    docs = [(k, head + textwrap.fill(text, 70)) for k, (_, text) in enumerate(TEXTS)]
    docs += [
        (100, whole["ISC"].replace("SPECIAL, DIRECT,\n", "")[:-40]),
        (101, whole["MIT"] + " word" * 3 + " " + " ".join(f"other{k}" for k in range(400))),
        (102, whole["Zlib"][: len(whole["Zlib"]) // 2]),
        (103, whole["Zlib"] * 40),
        (104, "merchantability and fitness of this software"),
        (105, " ".join(f"line{k}" for k in range(20_000)) + whole["Zlib"]),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.license): r.dice for r in scan_licenses(df).collect()}
    expected = {(i, name): dice for i, name, dice, _ in brute_licenses(docs)}
    # Runs of words find notices that no line, sentence or paragraph holds; passages are those of the plain version.
    assert {k: v for k, v in got.items() if k in expected} == expected
    for k, (name, _) in enumerate(TEXTS):
        assert got[k, name] > 0.9
        assert got[k, name] == max(v for (i, _), v in got.items() if i == k)
    assert {name for i, name in got if i == 100} == {"ISC"} and {name for i, name in got if i == 101} == {"MIT"}
    assert not {i for i, _ in got} & {102, 104, 105} and (103, "Zlib") in got


def test_licenses_against_all_runs(spark):
    """Notices with words changed, wrapped anywhere among others: found where any run of words reaches the threshold."""
    rng = random.Random(7)
    docs = []
    for i in range(60):
        said = words(rng.choice(TEMPLATES)[1])
        for _ in range(rng.randrange(4)):
            said[rng.randrange(len(said))] = rng.choice(["tool", "the", "license", "gnu", "file"])
        said = [rng.choice("abcdefg") for _ in range(rng.randrange(9))] + said + [rng.choice("abc") for _ in range(5)]
        docs.append((i, "".join(w + rng.choice([" ", " ", "\n", "\n# ", ", "]) for w in said)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.license): r.dice for r in scan_licenses(df).collect()}
    passages = {(i, name) for i, name, _, _ in brute_licenses(docs)}
    best: dict = {}
    for i, text in docs:
        w = words(text)
        grams = list(zip(w, w[1:], strict=False))
        for name, template in TEMPLATES:
            other = {tuple(x.split()) for x in template_bigrams(template)}
            most = int(1.5 * (len(words(template)) - 1) + 1e-9)
            for a in range(len(grams)):
                for b in range(a + 1, min(a + most, len(grams)) + 1):
                    own = set(grams[a:b])
                    dice = 2 * len(own & other) / (len(own) + len(other))
                    if dice >= 0.8:
                        best[i, name] = max(best.get((i, name), 0), dice)
    assert set(got) == set(best) | passages and len(got) > 30
    assert all(got[k] == v for k, v in best.items() if k not in passages)


def test_licenses_wrapped_over_lines_and_in_comments(spark):
    header = """/*
 * A tool for things.
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
 * GNU General Public License for more details.
 */"""
    more = " ".join(f"word{k}" for k in range(40))
    mpl = next(text for name, text in TEMPLATES if name == "MPL-2.0")
    mit = TEMPLATES[14][1].replace("copy of", "copy\n# of").replace("the rights", "the\n# rights")
    docs = [
        (1, "What follows is\nabout the tool. Licensed under the Apache\nLicense, Version 2.0.\nThe tool has more."),
        (2, "Text before it, and\nThis work is licensed under the GNU\nGeneral Public License, version 3.\nSome more."),
        (3, header),
        (4, f"Some words stand before it in this line: {more} {mpl[:-1]} {more}"),
        (5, f"# Some file with\n# {more}\n# {mit}\n# {more}"),
        (6, "Here all rights\nreserved for members, and the MIT\nlicense plate is released under the seat."),
        (7, "one is Licensed under the\nMIT License and two is released\nunder the MIT License as well"),
        (8, "Released under the MIT License."),
        (9, "word " * 20_000 + "All\nrights reserved\nby " + "word " * 20_000),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.license): (r.dice, r.n_matches) for r in scan_licenses(df).collect()}
    assert not {(i, name) for i, name, _, _ in brute_licenses(docs)} - set(got)
    assert {k: v for k, v in got.items() if v[0] == 1.0} == {
        (1, "Apache-2.0"): (1.0, 1),
        (2, "GPL-3.0"): (1.0, 1),
        (3, "GPL-3.0"): (1.0, 1),
        (4, "MPL-2.0"): (1.0, 1),
        (5, "MIT"): (1.0, 1),
        (6, "Proprietary"): (1.0, 1),
        (7, "MIT"): (1.0, 2),
        (8, "MIT"): (1.0, 1),
        (9, "Proprietary"): (1.0, 1),
    }
    assert {k for k, v in got.items() if v[0] < 1.0} == {(2, "GPL-2.0")}


def test_decontaminate_keeps_columns_of_any_name(spark):
    item = " ".join(f"w{k}" for k in range(12))
    rows = [(1, f"lead {item} tail", "x", "y"), (2, "a clean text of some words", "x", "y"), (None, item, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __held string, __held_ string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decontaminate(df, items)
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [rows[1]]


def test_items_of_all_sizes(spark):
    """Items from one shingle to hundreds, whole and just above and below the threshold, against plain sets."""
    words = [f"v{k}" for k in range(900)]
    items = [(size, words[:300][-size:] if size < 300 else words[:size]) for size in (5, 6, 8, 9, 20, 70, 300, 500)]
    docs = []
    for k, (_, w) in enumerate(items):
        for cut in (0, len(w) // 6, len(w) // 5, len(w) // 3):
            docs.append((len(docs), f"start {k} {cut} " + " ".join(w[cut:]) + " end " + " ".join(f"z{k}{j}" for j in range(50))))

    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = set()
    for i, text in docs:
        for j, w in items:
            own = shingles(" ".join(w))
            shared = len(own & shingles(text))
            if shared >= 0.8 * len(own):
                want.add((i, j, len(own), shared))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in items], "item_id long, text string")
    got = contained_items(df, bench).collect()
    assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got} == want and len(got) == len(want)
    sizes = [r[0] for r in spark.range(1, 70).select(size_class("id")).collect()]
    assert sizes == [k.bit_length() - 1 for k in range(1, 70)]
