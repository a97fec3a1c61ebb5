"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest

from tripmart.llm import repair
from tripmart.llm.queries import QUERIES
from tripmart.llm.repair import repair_conversations, solve

SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def search(kinds):
    """Least (cost, audit) over all edits; kinds: (role initial, must be deleted, truncated) of each row."""

    @cache
    def best(k, state, room):
        options = []
        if k == len(kinds):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            role, gone, cut = kinds[k]
            cost, rest = best(k + 1, state, 2)
            options.append((4 + cost, "D" + rest))
            if not gone:
                keeps = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role and role in keeps:
                    cost, rest = best(k + 1, role, 2)
                    options.append((3 * cut + cost, "K" + rest))
                cost, rest = best(k + 1, "a" if state == "u" else "u", 2)
                options.append((3 + 3 * cut + cost, "R" + rest))
        if room:
            cost, rest = best(k, "a" if state == "u" else "u", room - 1)
            options.append((3 + cost, "I" + rest))
        return min(options, default=(1 << 40, ""))

    return best(0, "", 2)


def brute(originals, rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role, text))
    out = {}
    for conv in {r[0] for r in originals}:
        said = sorted(talks[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in said if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds, count, seen = [], [0, 0, 0], set()
        for _, role, text in said:
            solid = text.strip(SPACE)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                count[fault] += 1
            kinds.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit = search(tuple(kinds))
        lines, left, last = [], iter(said), "a"
        for x in audit:
            row = None if x == "I" else next(left)
            if x == "D":
                continue
            role = row[1] if x == "K" else ("assistant" if last == "u" else "user")
            last = role[:1]
            lines.append(f"{role}:{row[2] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *count, illegal, cost, audit, digest)
    return out


def ours(df):
    got = {}
    for r in df.collect():
        assert r.conv_id not in got
        got[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
    return got


def test_supplied_conversations(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(rows, damaged(rows))
    assert ours(QUERIES["op11_conversation_repair"](spark, sf_dir)) == want
    assert {x for r in want.values() for x in r[6]} == set("DIKR")


def test_cheapest_edits_of_least_letters():
    rng = random.Random(3)
    for _ in range(3000):
        kinds = [(rng.choice("ssuuuaaao"), rng.random() < 0.1, rng.random() < 0.2) for _ in range(rng.randrange(0, 12))]
        symbols = "".join("x" if gone else role.upper() if cut else role for role, gone, cut in kinds)
        assert solve(symbols) == search(tuple(kinds)), symbols
    long = "uuuu" * 50 + "a" * 77 + "x" * 30 + "ua" * 20 + "S" * 33 + "O" * 9
    kinds = tuple(("o" if x in "xO" else x.lower(), x == "x", x.isupper()) for x in long)
    __import__("sys").setrecursionlimit(20_000)
    assert solve(long) == search(kinds)


def edge_rows(seed=1, n=400):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Well", " ", "", None, "a\nb.", "é?", "…", "　", "Ok. \t", "x" * 3000 + "."]
    roles = ["system", "user", "assistant", "tool", "", None, "User", "u"]
    turns = [None, *range(-3, 12)]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice(turns), rng.choice(roles), rng.choice(texts)) for _ in range(n)]
    rows += [(7, None, "user", None)] * 3 + [(8, 5, "user", "Same.")] * 40 + [(9, 1 << 40, "assistant", "End.")]
    return rows + [(10, t, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(300)]


@pytest.mark.parametrize("slice_rows", [1024, 3])
def test_edges(spark, monkeypatch, slice_rows):
    """Also in slices of three rows, through the tree of blocks of four slices."""
    rows = edge_rows()
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, __conv string")
    if slice_rows == 3:
        import importlib
        from pyspark import cloudpickle

        monkeypatch.setattr(repair, "SLICE_ROWS", 3)
        monkeypatch.setattr(repair, "_FAN", 4)
        cloudpickle.register_pickle_by_value(repair)
        try:
            got = ours(repair_conversations(df.repartition(5)))
        finally:
            cloudpickle.unregister_pickle_by_value(repair)
            importlib.invalidate_caches()
    else:
        got = ours(repair_conversations(df.repartition(5)))
        assert repair_conversations(df.where("false")).count() == 0
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = brute(plain, plain)
    for conv, expected in want.items():
        assert got[conv] == expected, conv
    assert got.keys() == want.keys()


def test_one_conversation_holds_all_rows(spark):
    """More than a slice, over several tasks; cost and audit against one pass over all symbols."""
    n = 12_000
    df = spark.range(n).selectExpr(
        "7L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'assistant', 'user') AS role",
        "concat('Turn ', IF(id % 50 = 0, 50, id), IF(id % 7 = 0, '', '.')) AS text",
    )
    (got,) = repair_conversations(df.repartition(6)).collect()
    symbols, lines = [], []
    for i in range(n):
        again = i % 50 == 0 and i > 0 and (i % 3 == 0, i % 7 == 0) in {(j % 3 == 0, j % 7 == 0) for j in range(0, i, 50)}
        role = "a" if i % 3 == 0 else "u"
        symbols.append("x" if again else role.upper() if i % 7 == 0 else role)
    cost, audit = repair._solved.__wrapped__("".join(symbols))
    assert (got.cost, got.duplicate, got.gaps) == (cost, symbols.count("x"), 0)
    assert got.audit == audit
    last, at = "a", 0
    for x in audit:
        text = f"Turn {50 if at % 50 == 0 else at}{'' if at % 7 == 0 else '.'}"
        if x != "D":
            role = ("assistant" if at % 3 == 0 else "user") if x == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{'' if x == 'I' else text}")
        at += x != "I"
    assert got.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_a_conversation_of_which_no_row_is_left(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (2, 0, "user", "")], "conv_id long, turn long, role string, text string")
    got = ours(repair_conversations(df, present=df["turn"] > 0))
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {1: (0, 0, 0, 0, 0, 0, "", empty), 2: (0, 0, 0, 0, 0, 0, "", empty)}
    assert ours(repair_conversations(df))[2] == (0, 1, 0, 0, 0, 4, "D", empty)
