"""Filter interaction audit: what each filter removes, for every order in which the filters can be applied.

A document's failures are bits, one for each filter. All filters but one look at a document alone. The *existential*
one asks for another document: it fails where a document of smaller id has the same text, found by a left-semi
self-join on hash, exact text and smaller id, whose right side keeps the least id of each text. Its ids are united
with the other failures, the bits of a document are combined, and documents are counted by combination of bits.
From then on everything is arithmetic on a few hundred rows: what a filter removes at a step depends only on the
set of filters before it, so 80 pairs of set and filter (for five) serve all 120 orders.

*Hot texts.* A group of copies that by rows or bytes is more than a quarter of what a shuffle partition holds on
average is hot. There can be no more than eight of those for each partition, so their list is broadcast. Copies of a
hot text are dealt by a hash of their id in as many shares as it takes for each to be no hot group, but no more than
there are copies, and each share gets the least id of the text. All other groups share the partitions as they are.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups of copies that would fill a partition on average; a larger group is dealt.
GROUPS_A_PARTITION = 4

_SPACE = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_words(text: Column) -> Column:
    """Maximal runs of characters other than space and 0x09-0x0D."""
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def few_words(text: Column) -> Column:
    return F.size(text_words(text)) < 100


def repetitive(text: Column) -> Column:
    words = text_words(text)
    return F.lit(100) * F.size(F.array_distinct(words)) < F.lit(80) * F.size(words)


def many_capitals(text: Column) -> Column:
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return F.lit(100).cast("long") * capitals > F.lit(10).cast("long") * F.length(text)


def has_symbols(text: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: Failure conditions over the text of one document, by letter. The existential filter is none of them.
CONDITIONS: Mapping[str, Callable[[Column], Column]] = {
    "A": few_words,
    "B": repetitive,
    "C": many_capitals,
    "D": has_symbols,
}


def _rows(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("__id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("__part"),
        F.xxhash64(text).alias("__hash"),
        text.alias("__text"),
    )


def repeated_rows(rows: DataFrame) -> DataFrame:
    """The rows (``__id``, ``__part``, ``__hash``, ``__text``) of which another row of smaller id has the text."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.octet_length("__text").cast("long")
    n_rows, n_bytes = rows.agg(F.count("*"), F.sum(size)).first()
    counts = rows.groupBy("__hash").agg(F.count("*").alias("__n"), F.sum(size).alias("__bytes"))

    def shares(c: str, total: int | None) -> Column:
        return F.ceil(F.col(c) * GROUPS_A_PARTITION * partitions / F.lit(float(total or 1)))

    dealt_to = F.least("__n", F.greatest(shares("__n", n_rows), shares("__bytes", n_bytes)))
    hot = F.broadcast(counts.select("__hash", dealt_to.cast("int").alias("__shares")).where("__shares > 1"))

    def least(some: DataFrame, *more: str) -> DataFrame:
        firsts = some.where(F.col("__id").isNotNull()).groupBy("__hash", *more, "__text")
        return firsts.agg(F.min("__id").alias("__first")).withColumnsRenamed({"__hash": "__h", "__text": "__t"})

    def exists(left: DataFrame, right: DataFrame, *more: Column) -> DataFrame:
        same = (F.col("__hash") == F.col("__h")) & (F.col("__text") == F.col("__t"))
        for condition in more:
            same &= condition
        return left.join(right, same & (F.col("__first") < F.col("__id")), "left_semi")

    plain = rows.join(hot, "__hash", "left_anti")
    common = rows.join(hot, "__hash")
    share = F.pmod(F.xxhash64("__id"), F.col("__shares")).cast("int")
    everywhere = least(common, "__shares").withColumn("__s", F.explode(F.expr("sequence(0, __shares - 1)")))
    dealt = common.withColumn("__share", share).drop("__shares")
    return exists(plain, least(plain)).unionByName(
        exists(dealt, everywhere.drop("__shares"), F.col("__share") == F.col("__s")).drop("__share")
    )


def failure_bits(
    docs: DataFrame,
    conditions: Mapping[str, Callable[[Column], Column]] = CONDITIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """``__id``, ``__part``, ``__bits``, ``__n``: how many rows of an id and part fail which filters.

    Bit k stands for the k-th of ``conditions``; the bit after the last one for the existential filter.
    """
    rows = _rows(docs, id_col, text_col, part_col)
    alone = F.lit(0)
    for k, fails in enumerate(conditions.values()):
        alone = alone + F.when(fails(F.col("__text")), 1 << k).otherwise(0)
    key = ["__id", "__part", "__hash"]
    checked = rows.select(*key, alone.alias("__bits"), F.lit(1).cast("long").alias("__n"))
    repeated = repeated_rows(rows).select(
        *key, F.lit(1 << len(conditions)).alias("__bits"), F.lit(0).cast("long").alias("__n")
    )
    united = checked.unionByName(repeated).groupBy(*key).agg(
        F.bit_or("__bits").alias("__bits"), F.sum("__n").alias("__n")
    )
    return united.groupBy("__id", "__part", "__bits").agg(F.sum("__n").alias("__n"))


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    conditions: Mapping[str, Callable[[Column], Column]] = CONDITIONS,
    existential: str = "E",
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """A row per part, order of all filters and step: ``part``, ``filter_order``, ``step`` (from 1), and the counts of
    documents ``kept`` (after the step), ``removed`` (by it), ``redundant`` (fail its filter, removed earlier),
    ``unique_fails`` (fail its filter only), ``good_lost`` and ``toxic_lost`` (removed by it, with a label
    ``quality`` = 1 or ``toxic`` = 1) and ``shapley`` (removed by its filter, summed over all orders).

    ``conditions``: letter to failure condition over the text; ``existential`` is the letter of the filter that a
    document fails when one of smaller id has the same text. Filters are applied left to right in ``filter_order``.
    There are n! orders: meant for six filters at most.

    Defined cases: a null text is empty; a null part is the empty string; repeated rows count each, and don't
    remove each other, as none has a smaller id; a null id is neither smaller nor greater than any other; several
    labels of an id are one that has any of their marks; an id without labels has none; a table without rows
    gives no rows; extra columns are left out.
    """
    letters = [*conditions, existential]
    places = {x: k for k, x in enumerate(letters)}
    marks = labels.groupBy(F.col(id_col).cast("long").alias("__id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("__good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("__toxic"),
    )
    bits = failure_bits(docs, conditions, id_col, text_col, part_col)
    no = F.lit(False)
    combined = (
        bits.join(marks, "__id", "left")
        .groupBy("__part", "__bits", F.coalesce("__good", no).alias("__good"), F.coalesce("__toxic", no).alias("__toxic"))
        .agg(F.sum("__n").alias("__n"))
    )

    # Every set of earlier filters with every filter that is not among them.
    every = range(1 << len(letters))
    cases = F.array(
        *[F.struct(F.lit(s).alias("before"), F.lit(1 << k).alias("own")) for k in places.values() for s in every if not s >> k & 1]
    )
    rows = combined.select("*", F.explode(cases).alias("__case")).select("*", "__case.*").drop("__case")
    earlier = F.col("__bits").bitwiseAND(F.col("before")) != 0
    fails = F.col("__bits").bitwiseAND(F.col("own")) != 0
    here = fails & ~earlier

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("__n")).otherwise(0)).alias(name)

    counted = rows.groupBy("__part", "before", "own").agg(
        total(~fails & ~earlier, "kept"),
        total(here, "removed"),
        total(fails & earlier, "redundant"),
        total(F.col("__bits") == F.col("own"), "unique_fails"),
        total(here & F.col("__good"), "good_lost"),
        total(here & F.col("__toxic"), "toxic_lost"),
    )
    # An order has the set before a filter in as many ways as that set and the rest can be ordered.
    size = F.bit_count("before")
    n = len(letters)
    ways = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), size + 1)
    worth = counted.groupBy("__part", "own").agg(F.sum(F.col("removed") * ways).cast("long").alias("shapley"))

    steps = [
        ("".join(order), k + 1, sum(1 << places[x] for x in order[:k]), 1 << places[order[k]])
        for order in itertools.permutations(letters)
        for k in range(n)
    ]
    steps = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, own int")
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return (
        counted.join(worth, ["__part", "own"])
        .join(F.broadcast(steps), ["before", "own"])
        .select(F.col("__part").alias("part"), "filter_order", "step", *[F.col(c).cast("long") for c in counts], "shapley")
    )
