"""Chat formatting: logged snapshots of a growing conversation are collapsed, then the longest are rendered.

A conversation that was logged after every reply appears many times, each time as a prefix of the next. Every
turn gets a hash of its place, role and text; the rolling hash of a prefix is the running sum of those, in three
lanes of 40 bits. A conversation is redundant when its whole hash is the hash of a proper prefix of another one
(an anti-join), or when an equal conversation has a smaller id.

Turns are numbered in slices, so a conversation that holds a third of all rows is not put in one task, and
prefix hashes are combined before they are shuffled, so an opening that a third of all conversations share isn't
either. Prefix hashes are written to the scratch folder, once, before they are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.sources.scratch import scratch_path

#: Turn numbers of a slice, and turns that are rendered into one row.
SLICE = 1024
_NULL_ID = (1 << 63) - 1
_LANES = ("__h0", "__h1", "__h2")


_KEYS = ("__conv", "__slice", "__turn", "__role", "__text_a", "__text_b")


def _named(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with their text and two hashes of it; a null text has hashes of its own."""
    rows = conversations.select(
        F.coalesce(F.col(conv).cast("long"), F.lit(_NULL_ID)).alias("__conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(_NULL_ID)).alias("__turn"),
        F.col(role).cast("string").alias("__role"),
        F.col(text).cast("string").alias("__text"),
    )
    is_null = F.col("__text").isNull()
    return rows.select(
        "*",
        F.expr(f"__turn div {SLICE}").alias("__slice"),
        F.xxhash64(is_null, "__text").alias("__text_a"),
        F.xxhash64(F.lit(1), is_null, "__text").alias("__text_b"),
    )


def _before(rows: DataFrame, columns: dict) -> DataFrame:
    """Aggregates of each slice summed over all earlier slices of its conversation, as ``<name>_before``, and over
    all slices, as ``<name>_all``; ``columns`` maps names to aggregates of a slice."""
    slices = rows.groupBy("__conv", "__slice").agg(*[c.alias(x) for x, c in columns.items()])
    whole = Window.partitionBy("__conv").orderBy("__slice")
    earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = [F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}_before") for x in columns]
    return slices.select("__conv", "__slice", *sums, *[F.sum(x).over(every).alias(f"{x}_all") for x in columns])


def _prefixes(named: DataFrame) -> DataFrame:
    """``__conv``, ``__place`` (from 1), ``__size`` (turns of the conversation), the lanes of the hash of all distinct
    turns up to this one.

    All steps on single turns use the one partitioning by conversation and slice; texts are left out.
    """
    turns = named.select(*_KEYS).repartition("__conv", "__slice").distinct()
    in_slice = Window.partitionBy("__conv", "__slice").orderBy("__turn", "__role", "__text_a", "__text_b")
    placed = turns.join(_before(turns, {"__n": F.count("*")}), ["__conv", "__slice"]).withColumn(
        "__place", F.col("__n_before") + F.row_number().over(in_slice)
    )
    parts = ["__place", F.col("__role").isNull(), "__role", "__text_a", "__text_b"]
    lanes = {x: F.xxhash64(F.lit(k), *parts).bitwiseAND(F.lit((1 << 40) - 1)) for k, x in enumerate(_LANES)}
    hashed = placed.select(
        "__conv", "__slice", "__place", F.col("__n_all").alias("__size"), *[c.alias(x) for x, c in lanes.items()]
    )
    carried = _before(hashed, {x: F.sum(x) for x in _LANES})
    running = Window.partitionBy("__conv", "__slice").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.join(carried, ["__conv", "__slice"]).select(
        "__conv", "__place", "__size", *[(F.sum(x).over(running) + F.col(f"{x}_before")).alias(x) for x in _LANES]
    )


def collapse_snapshots(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv``, ``n_turns``, ``n_copies`` (equal conversations, this one included) of the maximal conversations.

    Defined cases: turns are ordered by number (null last), then role, then a hash of the text; repeated equal
    rows count once; a null role or text is a value of its own; of equal conversations the smallest id stays; a
    null id is one conversation, larger than all others; an empty table gives no rows.
    """
    spark = conversations.sparkSession
    path = scratch_path(spark, "prefixes")
    _prefixes(_named(conversations, conv, turn, role, text)).write.parquet(path)
    prefixes = spark.read.parquet(path)
    key = ["__place", *_LANES]
    whole = prefixes.where("__place = __size").groupBy(*key).agg(
        F.min("__conv").alias("__conv"), F.count("*").alias("n_copies")
    )
    proper = prefixes.where("__place < __size").select(*key).distinct()
    return whole.join(proper, key, "left_anti").select(
        F.nullif("__conv", F.lit(_NULL_ID)).alias(conv), F.col("__place").cast("long").alias("n_turns"), "n_copies"
    )


def render_chats(
    conversations: DataFrame,
    template: str = "<|{role}|>\n{text}\n",
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv``, ``part``, ``n_turns`` (of the conversation), ``n_copies``, ``chat`` of the maximal conversations.

    Each turn is written by ``template``; a null role or text is empty. Turns of a slice of 1024 numbers are one
    row, with parts counted by turn number from 0, so a conversation of any length is rendered in bounded rows.
    See :func:`collapse_snapshots` for the order of turns and the other defined cases.
    """
    turns = _named(conversations, conv, turn, role, text)
    path = scratch_path(conversations.sparkSession, "maximal")
    collapse_snapshots(conversations, conv, turn, role, text).write.parquet(path)
    # Read from a table its size is known, so the texts of what was collapsed need no shuffle where it is small.
    kept = conversations.sparkSession.read.parquet(path).select(
        F.coalesce(F.col(conv), F.lit(_NULL_ID)).alias("__conv"), "n_turns", "n_copies"
    )
    pieces: list = []
    for k, literal in enumerate(template.split("{role}")):
        if k:
            pieces.append(F.coalesce("__role", F.lit("")))
        for j, rest in enumerate(literal.split("{text}")):
            if j:
                pieces.append(F.coalesce("__text", F.lit("")))
            pieces.append(F.lit(rest))
    one = F.struct("__turn", "__role", "__text_a", "__text_b", F.concat(*pieces).alias("__written"))
    return (
        turns.join(kept, "__conv")
        .groupBy("__conv", "__slice", "n_turns", "n_copies")
        .agg(F.array_sort(F.collect_set(one)).alias("__all"))
        .select(
            F.nullif("__conv", F.lit(_NULL_ID)).alias(conv),
            F.col("__slice").alias("part"),
            "n_turns",
            "n_copies",
            F.array_join(F.col("__all.__written"), "").alias("chat"),
        )
    )
