"""Conversation structure repair: the cheapest edits that make roles alternate, and an audit of them.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials: nothing, or an optional system turn and
then pairs of user and assistant. A row may be kept, given another role or deleted, and empty turns inserted. That
is a walk through four states (nothing yet, after system, after user, after assistant); a row's symbol, its role's
initial and its fault, fixes the costs of one step as a 4 x 4 matrix of the min-plus semiring.

*Run-length DP.* Equal consecutive symbols are one run. A run of n rows is advanced by at most log2 n products
with the binary powers of its symbol's matrix, which are computed once. That gives, from the end, what each state
costs to finish at every border of runs. Inside a run the costs of all its rows come from the same powers by
doubling. Then the edits are read off forwards: of those on a cheapest walk the one of least letter, which makes
the audit the least of all cheapest ones, as a state and a letter fix the next state.

*Long conversations.* Rows are sorted by conversation and turn over ranges, so the rows of one conversation may lie
in many tasks. Pieces that end inside a task are finished there. The rest is cut into slices of bounded size, and
matrices of slices are multiplied in a tree of blocks: first the costs to finish after every slice, then, the same
way, the state in which the cheapest walk enters it, and last the edits, by slice. Rows that are equal in all
columns are counted before the sort, so they can't fill a range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.sources.scratch import scratch_path

#: Costs of the edits. A truncated row that isn't deleted adds its own.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows and bytes of text of a slice of a long conversation, and slices of a block of the tree.
SLICE_ROWS, SLICE_BYTES = 1024, 1 << 20
_FAN = 256

_NULL_ID = (1 << 63) - 1
_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 50

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. What an inserted or re-roled turn is, and
# where it leads, is fixed by the state.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_ENDS = (0, 3)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product; ``a`` may be a stack of rows."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _FAR)


def _inserts() -> np.ndarray:
    """Costs to get from state to state by inserted turns alone."""
    out = np.full((4, 4), _FAR, dtype=np.int64)
    for state in range(4):
        at, cost = state, 0
        while out[state, at] > cost:
            out[state, at] = cost
            at, cost = _NEXT[at], cost + INSERT
    return out


def _kept(symbol: str, state: int) -> int | None:
    """State after a row is kept, None if its role doesn't follow."""
    role = symbol.lower()
    if role == "s":
        return 1 if state == 0 else None
    if role in ("u", "a"):
        to = _NEXT[state]
        return to if _ROLE[state][0] == role else None
    return None


@lru_cache(maxsize=1024)
def power(symbol: str, k: int) -> np.ndarray:
    """Min-plus matrix of 2**k rows of a symbol, insertions before each of them included."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    step = np.full((4, 4), _FAR, dtype=np.int64)
    for state in range(4):
        step[state, state] = DELETE
        if symbol != "x":
            stays = TRUNCATED if symbol.isupper() else 0
            to = _NEXT[state]
            step[state, to] = min(step[state, to], REROLE + stays)
            if (to := _kept(symbol, state)) is not None:
                step[state, to] = min(step[state, to], stays)
    return _times(_inserts(), step)


#: Cost to finish from each state after the last row: insertions up to a state that may end.
FINISH = _inserts()[:, list(_ENDS)].min(axis=1)


def runs_of(symbols: str) -> list[tuple[str, int]]:
    return [(x, len(list(same))) for x, same in groupby(symbols)]


def advance(symbol: str, n: int, after: np.ndarray) -> np.ndarray:
    """Costs to finish before a run, from those after it."""
    k = 0
    while n:
        if n & 1:
            after = np.minimum((power(symbol, k) + after).min(axis=1), _FAR)
        n >>= 1
        k += 1
    return after


def slice_matrix(symbols: str) -> np.ndarray:
    """Min-plus matrix of all rows of a slice."""
    columns = [slice_costs(symbols, np.where(np.arange(4) == k, 0, _FAR)) for k in range(4)]
    return np.stack(columns, axis=1)


def slice_costs(symbols: str, after: np.ndarray) -> np.ndarray:
    for symbol, n in reversed(runs_of(symbols)):
        after = advance(symbol, n, after)
    return after


def _inside(symbol: str, n: int, after: np.ndarray) -> np.ndarray:
    """(n, 4): costs to finish after the k-th row of a run, by doubling with the powers of its matrix."""
    back = after[None, :]
    k = 0
    while len(back) < n:
        back = np.concatenate([back, np.minimum((power(symbol, k)[None] + back[:, None, :]).min(axis=2), _FAR)])
        k += 1
    return back[:n][::-1]


def unroll(symbols: str, state: int, after: np.ndarray, last: bool = True) -> tuple[str, int]:
    """(audit, state at the end) of the cheapest walk of least audit that enters in ``state``.

    ``after`` are the costs to finish after the last row; ``last``: nothing follows, so turns are inserted at the end.
    """
    runs = runs_of(symbols)
    borders = [after]
    for symbol, n in reversed(runs):
        borders.append(advance(symbol, n, borders[-1]))
    out = []
    for (symbol, n), border in zip(runs, reversed(borders[:-1]), strict=True):
        stays = TRUNCATED if symbol.isupper() else 0
        for costs in _inside(symbol, n, border).tolist():
            while True:
                to, kept = _NEXT[state], _kept(symbol, state)
                delete = DELETE + costs[state]
                keep = _FAR if symbol == "x" or kept is None else stays + costs[kept]
                rerole = _FAR if symbol == "x" else REROLE + stays + costs[to]
                # An insertion first: the same row from the state that follows.
                best = min(delete, keep, rerole)
                insert = INSERT + _from(symbol, to, costs, stays)
                if delete <= min(best, insert):
                    out.append("D")
                    break
                if insert <= best:
                    out.append("I")
                    state = to
                    continue
                if keep <= rerole:
                    out.append("K")
                    state = kept
                else:
                    out.append("R")
                    state = to
                break
    while last and state not in _ENDS:
        out.append("I")
        state = _NEXT[state]
    return "".join(out), state


def _from(symbol: str, state: int, costs: list[int], stays: int) -> int:
    """Cost to finish from ``state`` before a row after which ``costs`` hold."""
    best, spent = _FAR, 0
    for _ in range(3):
        options = [DELETE + costs[state]]
        if symbol != "x":
            options.append(REROLE + stays + costs[_NEXT[state]])
            if (kept := _kept(symbol, state)) is not None:
                options.append(stays + costs[kept])
        best = min(best, spent + min(options))
        state, spent = _NEXT[state], spent + INSERT
    return best


@lru_cache(maxsize=100_000)
def _solved(symbols: str) -> tuple[int, str]:
    return int(slice_costs(symbols, FINISH)[0]), unroll(symbols, 0, FINISH)[0]


def solve(symbols: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation; short ones are remembered, as few kinds of them make up most."""
    return _solved(symbols) if len(symbols) <= 64 else _solved.__wrapped__(symbols)


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    #: Equal rows that follow each other, this one included.
    count: int


def symbol_of(row: Row, seen: bool) -> tuple[str, str]:
    """(fault, symbol). Faults: ``b`` blank, ``d`` duplicate, ``t`` truncated, or none."""
    text = row.text.rstrip(_SPACE)
    if not text:
        return "b", "x"
    if seen:
        return "d", "x"
    role = row.role[:1] if row.role[:1] in ("s", "u", "a") else "o"
    if text[-1] not in ".!?":
        return "t", role.upper()
    return "", role


_LEGAL = {"su", "ua", "au"}


def _illegal(a: str, b: str) -> bool:
    return a[:1] + b[:1] not in _LEGAL


def repaired_lines(rows: list[Row], audit: str, state: int) -> Iterator[str]:
    """``role:text`` of what an audit leaves of rows and inserts; counted rows are walked one by one."""
    every = (r for r in rows for _ in range(r.count))
    for edit in audit:
        if edit == "I":
            yield f"{_ROLE[state]}:"
            state = _NEXT[state]
            continue
        row = next(every)
        if edit == "K":
            yield f"{row.role}:{row.text}"
            state = 1 if row.role[:1] == "s" else _NEXT[state]
        elif edit == "R":
            yield f"{_ROLE[state]}:{row.text}"
            state = _NEXT[state]


def _faults(rows: list[Row], seen: list[bool]) -> tuple[str, dict[str, int]]:
    """Symbols of all rows, and numbers of faults. Only the first of equal rows can be other than a duplicate."""
    out, count = [], {"b": 0, "d": 0, "t": 0, "": 0}
    for row, again in zip(rows, seen, strict=True):
        fault, symbol = symbol_of(row, again)
        count[fault] += 1
        out.append(symbol)
        if row.count > 1:
            count["b" if fault == "b" else "d"] += row.count - 1
            out.append("x" * (row.count - 1))
    return "".join(out), count


def _adjacent(rows: list[Row]) -> int:
    """Illegal neighbours among the rows."""
    own = sum((r.count - 1) * _illegal(r.role, r.role) for r in rows)
    return own + sum(_illegal(a.role, b.role) for a, b in zip(rows[:-1], rows[1:], strict=True))


def _turns(rows: list[Row]) -> tuple[int | None, int | None, int]:
    """(least, greatest, number of distinct) turns, nulls left out; rows are sorted by turn."""
    turns = [r.turn for r in rows if r.turn is not None]
    return (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)


def _gaps(least: int | None, most: int | None, distinct: int) -> int:
    return 0 if least is None else most - least + 1 - distinct


class Repaired(NamedTuple):
    gaps: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str
    repaired_sha256: str


def repair_rows(rows: list[Row]) -> Repaired:
    """All of one conversation that one task holds whole, rows in order."""
    said: set[tuple[str, str]] = set()
    seen = []
    for r in rows:
        seen.append((r.role, r.text) in said)
        said.add((r.role, r.text))
    symbols, count = _faults(rows, seen)
    cost, audit = solve(symbols)
    text = "\n".join(repaired_lines(rows, audit, 0))
    digest = hashlib.sha256(text.encode()).hexdigest()
    return Repaired(_gaps(*_turns(rows)), count["b"], count["d"], count["t"], _adjacent(rows), cost, audit, digest)


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ONE = f"__conv long, {_RESULT}, __seq long, __turns array<long>, __roles array<string>, __texts array<string>, __counts array<long>"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    def kind(x: str) -> pa.DataType:
        return pa.list_(_ARROW[x[6:-1]]) if x.startswith("array<") else _ARROW[x]

    return pa.schema([(n, kind(k)) for n, k in (c.split(" ", 1) for c in ddl.split(", "))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _schema(ddl)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, turn, role, text, count) to a finished row per conversation, or slices of it.

    The first and the last conversation of a task may go on in another one, and one of more than a slice is not
    held as a whole: those are given out as slices, numbered by task and place.
    """
    part = TaskContext.get().partitionId()
    now: list[Row] = []
    size = n_rows = 0
    conv: int | None = None
    first, cut, n_slices = True, False, 0
    out: list[tuple] = []

    def slice_row() -> tuple:
        nonlocal n_slices
        n_slices += 1
        columns = [list(c) for c in zip(*now, strict=True)]
        return (conv, *[None] * 8, (part << 32) + n_slices - 1, *columns)

    def close(edge: bool) -> None:
        nonlocal now, size, n_rows, cut
        if conv is not None and now:
            out.append(slice_row() if edge or cut else (conv, *repair_rows(now), *[None] * 5))
        now, size, n_rows, cut = [], 0, 0, False

    for batch in batches:
        for own, turn, role, text, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != conv:
                close(first)
                first = conv is None
                conv = own
            # No slice is longer than its bound; a great number of equal rows is several.
            while count:
                if now and (n_rows >= SLICE_ROWS or size >= SLICE_BYTES):
                    out.append(slice_row())
                    now, size, n_rows, cut = [], 0, 0, True
                here = min(count, SLICE_ROWS - n_rows) if n_rows < SLICE_ROWS else count
                now.append(Row(turn, role, text, here))
                size += len(text) + 16
                n_rows += here
                count -= here
            if len(out) >= 2000:
                yield _batch(out, _ONE)
                out = []
        if out:
            yield _batch(out, _ONE)
            out = []
    close(True)
    if out:
        yield _batch(out, _ONE)


def _slices(columns: list) -> Iterator[tuple[int, int, list[Row]]]:
    """(conv, seq, rows) of each slice."""
    for conv, seq, turns, roles, texts, counts in zip(*columns, strict=True):
        yield conv, seq, [Row(*r) for r in zip(turns, roles, texts, counts, strict=True)]


_LINK = (
    "__conv long, __seq long, __symbols string, __matrix array<long>, blank long, duplicate long, truncated long, "
    "illegal long, __least long, __most long, __distinct long, __head string, __tail string"
)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices with the places of their rows that say something first, to rows of ``_LINK``."""
    for batch in batches:
        out = []
        firsts = batch.column(6).to_pylist()
        for (conv, seq, rows), new in zip(_slices([c.to_pylist() for c in batch.columns[:6]]), firsts, strict=True):
            new = set(new or ())
            symbols, count = _faults(rows, [k not in new for k in range(len(rows))])
            head, tail = rows[0].role[:1], rows[-1].role[:1]
            matrix = slice_matrix(symbols).ravel().tolist()
            faults = (count["b"], count["d"], count["t"], _adjacent(rows))
            out.append((conv, seq, symbols, matrix, *faults, *_turns(rows), head, tail))
        yield _batch(out, _LINK)


def _scan(spark: SparkSession, nodes: DataFrame, whole: str, out: str, start: list[int], combine, share, base: str, level=0):
    """Prefix products over the slices of each conversation, by a tree of blocks of bounded size.

    ``nodes``: ``__conv``, ``__seq``, ``whole`` (array of long). Adds ``out``: for each node what holds at its border, from
    ``start`` for a whole conversation. ``combine`` makes one element of those of a block, ``share`` what holds at
    every node's border from what holds at the block's.
    """
    kind = f"__conv long, __seq long, {whole} array<long>"
    path = f"{base}/{out}{level}"
    nodes.select("__conv", "__seq", whole).write.parquet(path)
    nodes = spark.read.parquet(path)
    blocks = nodes.withColumn("__block", F.expr(f"__seq div {_FAN}"))
    if nodes.where("__seq > 0").isEmpty():
        return nodes.select("__conv", "__seq", F.array(*[F.lit(x).cast("long") for x in start]).alias(out))

    def up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("__seq")
        element = combine([np.array(x, dtype=np.int64) for x in table.column(whole).to_pylist()])
        return pa.Table.from_batches([_batch([(key[0].as_py(), key[1].as_py(), element.tolist())], kind)])

    def down(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("__seq")
        given = np.array(right.column("__given")[0].as_py(), dtype=np.int64)
        shared = share([np.array(x, dtype=np.int64) for x in left.column(whole).to_pylist()], given)
        rows = [(key[0].as_py(), s, x.tolist()) for s, x in zip(left.column("__seq").to_pylist(), shared, strict=True)]
        return pa.Table.from_batches([_batch(rows, f"__conv long, __seq long, {out} array<long>")])

    above = blocks.groupBy("__conv", "__block").applyInArrow(up, kind)
    above = _scan(spark, above, whole, out, start, combine, share, base, level + 1)
    above = above.select("__conv", F.col("__seq").alias("__block"), F.col(out).alias("__given"))
    return (
        blocks.groupBy("__conv", "__block")
        .cogroup(above.groupBy("__conv", "__block"))
        .applyInArrow(down, f"__conv long, __seq long, {out} array<long>")
    )


def _multiply(elements: list[np.ndarray]) -> np.ndarray:
    out = elements[0].reshape(4, 4)
    for x in elements[1:]:
        out = _times(out, x.reshape(4, 4))
    return out.ravel()


def _costs_after(elements: list[np.ndarray], after: np.ndarray) -> list[np.ndarray]:
    """Costs to finish after each of the slices, from those after the last one."""
    out = []
    for x in reversed(elements):
        out.append(after)
        after = np.minimum((x.reshape(4, 4) + after).min(axis=1), _FAR)
    return out[::-1]


def _compose(elements: list[np.ndarray]) -> np.ndarray:
    out = elements[0]
    for x in elements[1:]:
        out = x[out]
    return out


def _entered(elements: list[np.ndarray], state: np.ndarray) -> list[np.ndarray]:
    """State in which each of the slices is entered, from that of the first one."""
    out = []
    for x in elements:
        out.append(state)
        state = x[state]
    return out


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, seq, symbols, costs after) to (conv, seq, state left, for each state entered)."""
    for batch in batches:
        out = []
        for conv, seq, symbols, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            after = np.array(after, dtype=np.int64)
            out.append((conv, seq, [unroll(symbols, state, after, last=False)[1] for state in range(4)]))
        yield _batch(out, "__conv long, __seq long, __leaves array<long>")


_PIECE = f"{_LINK}, __cost long, __audit string, __lines string, __state long"


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices with their link, costs after and state entered, to their audit and what it leaves of them."""
    for batch in batches:
        n = len(_schema(_LINK))
        links = list(zip(*(c.to_pylist() for c in batch.columns[:n]), strict=True))
        rest = [c.to_pylist() for c in batch.columns[n:]]
        slices = _slices([[x[0] for x in links], [x[1] for x in links], *rest[:4]])
        out = []
        for link, (_, _, rows), after, state in zip(links, slices, rest[4], rest[5], strict=True):
            after = np.array(after, dtype=np.int64)
            audit, end = unroll(link[2], state[0], after, last=False)
            lines = "".join(f"{x}\n" for x in repaired_lines(rows, audit, state[0]))
            cost = int(slice_costs(link[2], after)[state[0]])
            out.append((*link[:2], None, None, *link[4:], cost, audit, lines, end))
        yield _batch(out, _PIECE)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and place to a finished row per conversation; texts pass through a digest."""
    names = _schema(_PIECE).names
    conv, held = None, {}

    def close() -> tuple:
        state, audit = held["state"], held["audit"]
        while state not in _ENDS:
            audit.append("I")
            add(f"{_ROLE[state]}:\n")
            state = _NEXT[state]
        faults = (held["blank"], held["duplicate"], held["truncated"], held["illegal"])
        gaps = _gaps(held["least"], held["most"], held["distinct"])
        return (conv, gaps, *faults, held["cost"], "".join(audit), held["digest"].hexdigest())

    def add(lines: str) -> None:
        if lines:
            held["digest"].update((("\n" if held["some"] else "") + lines[:-1]).encode())
            held["some"] = True

    for batch in batches:
        out = []
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            r = dict(zip(names, values, strict=True))
            if r["__conv"] != conv:
                if conv is not None:
                    out.append(close())
                conv = r["__conv"]
                held = {"digest": hashlib.sha256(), "some": False, "audit": [], "cost": r["__cost"], "tail": None}
                held |= {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "least": None, "most": None, "distinct": 0}
            for c in ("blank", "duplicate", "truncated", "illegal"):
                held[c] += r[c]
            if held["tail"] is not None:
                held["illegal"] += _illegal(held["tail"], r["__head"])
            held["tail"], held["state"] = r["__tail"], r["__state"]
            if r["__least"] is not None:
                held["distinct"] += r["__distinct"] - (held["most"] == r["__least"])
                held["least"] = r["__least"] if held["least"] is None else held["least"]
                held["most"] = r["__most"]
            held["audit"].append(r["__audit"])
            add(r["__lines"])
        if out:
            yield _batch(out, f"__conv long, {_RESULT}")
    if conv is not None:
        yield _batch([close()], f"__conv long, {_RESULT}")


def _long(spark: SparkSession, passed: DataFrame, base: str) -> DataFrame:
    """Finished rows of the conversations that lie in several slices."""
    payload = ["__turns", "__roles", "__texts", "__counts"]
    slices = passed.where(F.col("__seq").isNotNull()).select("__conv", "__seq", *payload)
    # The first time that something is said: one row of small columns for each row, combined before the shuffle.
    rows = slices.select("__conv", "__seq", F.posexplode(F.arrays_zip("__roles", "__texts")).alias("__k", "__row"))
    role, text = F.col("__row.__roles"), F.col("__row.__texts")
    said = rows.select(
        "__conv", role.alias("__role"), F.sha2(text, 256).alias("__text"), F.struct("__seq", "__k").alias("__at")
    )
    firsts = said.groupBy("__conv", "__role", "__text").agg(F.min("__at").alias("__at"))
    firsts = firsts.groupBy("__conv", F.col("__at.__seq").alias("__seq")).agg(F.collect_list("__at.__k").alias("__firsts"))
    marked = slices.join(firsts, ["__conv", "__seq"], "left").select("__conv", "__seq", *payload, "__firsts")
    marked.mapInArrow(_describe, _LINK).write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")

    # Blocks of slices need small numbers: tasks by rank (a row per task that has slices), slices within.
    width = links.agg(F.max(F.expr("__seq & 4294967295"))).first()[0]
    tasks = links.select(F.expr("__seq >> 32").alias("__task")).distinct()
    tasks = tasks.withColumn("__rank", F.row_number().over(Window.orderBy("__task")) - 1)
    dense = (F.col("__rank").cast("long") * F.lit((width or 0) + 1) + F.expr("__seq & 4294967295")).alias("__dense")
    numbered = links.withColumn("__task", F.expr("__seq >> 32")).join(tasks, "__task")
    # A conversation's first slice gets number 0, or the tree would never be down to one block.
    numbered = numbered.select("*", dense)
    lowest = numbered.groupBy("__conv").agg(F.min("__dense").alias("__lowest"))
    numbered = numbered.join(lowest, "__conv").select(
        "__conv", (F.col("__dense") - F.col("__lowest")).alias("__n"), "__seq", "__symbols", "__matrix"
    )
    numbered.write.parquet(f"{base}/numbered")
    numbered = spark.read.parquet(f"{base}/numbered")

    def nodes(df: DataFrame, column: str) -> DataFrame:
        return df.select("__conv", F.col("__n").alias("__seq"), column)

    after = _scan(
        spark, nodes(numbered, "__matrix"), "__matrix", "__after", FINISH.tolist(), _multiply, _costs_after, base
    ).withColumnRenamed("__seq", "__n")
    walks = numbered.join(after, ["__conv", "__n"]).select("__conv", "__n", "__symbols", "__after")
    leaves = walks.mapInArrow(_walks, "__conv long, __seq long, __leaves array<long>")
    entered = _scan(spark, leaves, "__leaves", "__state", [0], _compose, _entered, base).withColumnRenamed("__seq", "__n")
    known = numbered.select("__conv", "__n", "__seq").join(after, ["__conv", "__n"]).join(entered, ["__conv", "__n"])
    every = links.join(slices, ["__conv", "__seq"]).join(known.drop("__n"), ["__conv", "__seq"])
    pieces = every.select(*_schema(_LINK).names, *payload, "__after", "__state").mapInArrow(_edit, _PIECE)
    pieces.write.parquet(f"{base}/pieces")
    pieces = spark.read.parquet(f"{base}/pieces").repartition("__conv").sortWithinPartitions("__conv", "__seq")
    return pieces.select(*_schema(_PIECE).names).mapInArrow(_finish, f"__conv long, {_RESULT}")


def repair_conversations(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """A row per conversation: ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``repaired_sha256`` (``role:text`` of what is left, joined by line feeds).

    Edits: K keep, R give the role that must follow (3), D delete (4; required for blank and duplicate rows), I insert an
    empty turn of the role that must follow (3). A truncated row that isn't deleted costs 3 more. Among the
    cheapest, the audit of least letters. ``present``: condition under which a row counts; the others only name
    their conversation.

    Defined cases: rows are ordered by turn (null first), then role, then text; a null role or text is one space; a
    null id is one conversation; repeated rows are duplicates of the first; a conversation without a row that
    counts has zeros, an empty audit and the digest of the empty string; gaps leave null turns out (none but
    nulls: 0); an empty table gives no rows; extra columns are left out.
    """
    spark = conversations.sparkSession
    base = scratch_path(spark, "repair")
    counts = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = conversations.select(
        F.coalesce(F.col(conv).cast("long"), F.lit(_NULL_ID)).alias("__conv"),
        F.col(turn).cast("long").alias("__turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("__role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("__text"),
        counts.alias("__present"),
    )
    key = ["__conv", "__turn", "__role", "__text"]
    some = rows.where("__present").groupBy(*key).agg(F.count("*").alias("__count"))
    order = ["__conv", F.col("__turn").asc_nulls_first(), "__role", "__text"]
    ranged = some.repartitionByRange(*order).sortWithinPartitions(*order).select(*key, "__count")
    ranged.mapInArrow(_first_pass, _ONE).write.parquet(f"{base}/passed")
    passed = spark.read.parquet(f"{base}/passed")
    names = [c.split(" ")[0] for c in _RESULT.split(", ")]
    done = passed.where(F.col("__seq").isNull()).select("__conv", *names)
    found = done.unionByName(_long(spark, passed, base))

    none = {c: F.lit(0).cast("long") for c in names[:-2]}
    none |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    every = rows.select("__conv").distinct().join(found, "__conv", "left")
    return every.select(
        F.nullif("__conv", F.lit(_NULL_ID)).alias(conv), *[F.coalesce(c, none[c]).alias(c) for c in names]
    )


def damage(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, Column]:
    """Conversations with planted faults, and the condition under which a row of the result is still there.

    By crc32 of ``conv:turn`` (a null is one space) modulo 20: 0 drops a row, 1 empties its text, 2 removes its ``.``,
    ``!`` and ``?``, 3 repeats it, 4 makes it the user's. Dropped rows stay, without text, to name their conversation.
    """

    def given(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(given(conv), F.lit(":"), given(turn))) % 20
    rows = conversations.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(given(role)).alias("role"),
        F.when(kind.isin(0, 1), "")
        .when(kind == 2, F.translate(given(text), ".!?", ""))
        .otherwise(given(text))
        .alias("text"),
        kind.alias("damage"),
    )
    copies = F.when(F.col("damage") == 3, 2).otherwise(1)
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("copy"), F.col("damage") != 0
