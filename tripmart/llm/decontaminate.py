"""Benchmark items inside long documents, by MinHash containment search.

An item of n distinct shingles is contained when at least ``need`` = ceil(threshold * n) of them occur in the
document. Under one random order of all shingles (their hash), the item's signature is its n - need + 1 minwise
shingles: a document that contains the item misses fewer than that many, so it has at least one of them.

Items are partitioned by size, a class for each power of two, as the length of a signature and how far up the order
it reaches depend on the size. Every class has its own ceiling, the largest hash of its signatures, and a document is
looked up in a class with those of its shingles that lie below that ceiling. The document's own size neither dilutes
the search nor decides on a loss: every pair at the threshold becomes a candidate. Candidates are few; they are
written down, and verified by counting the item's shingles, as text, in the whole document.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.sources.scratch import scratch_path

#: Rows of 32 bytes that are broadcast at most; larger tables of signatures or candidates are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_NULL_ID = (1 << 63) - 1
_BETWEEN_WORDS = r"[^\p{L}\p{M}\p{N}]+"


def folded_words(text: Column | str) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(text), _BETWEEN_WORDS), "")


def computed(df: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``name`` = ``value``, computed once per row.

    A generator, as no predicate is pushed below it. Through a projection a predicate takes the whole expression
    along, in a lambda even for each element, which makes long documents take quadratic time.
    """
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def _runs(words: str, n: int, function: str) -> Column:
    """``function`` of each ``n`` consecutive elements. They are read by place: ``slice`` would copy the whole
    array for each run, which takes time with the square of a document's length.
    """
    each = ", ".join(f"get({words}, i + {k})" for k in range(n))
    return F.expr(f"transform(sequence(0, size({words}) - {n}), i -> {function}{each}))")


def shingle_texts(words: str, n: int) -> Column:
    """Distinct shingles of the array column ``words``; fewer than ``n`` words have none."""
    none = F.array().cast("array<string>")
    return F.when(F.size(words) >= n, F.array_distinct(_runs(words, n, "concat_ws(' ', "))).otherwise(none)


def _shingle_hashes(words: str, n: int) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= n, _runs(words, n, "xxhash64(")).otherwise(none)


def size_class(size: Column | str) -> Column:
    """Number of the class of items of so many shingles: the exponent of the power of two below."""
    return F.floor(F.log2(F.col(size) + 0.5)).cast("int")


def _small(df: DataFrame) -> DataFrame:
    """With the hint to broadcast it, if it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    shingle_words: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``item_col``, ``n_item_shingles``, ``n_shared``, ``containment`` of all contained items.

    Words are lower-cased runs of letters and digits; shingles are ``shingle_words`` of them. Items of equal
    words are one, named by the least id. One row per document id and item.

    Defined cases: an item of fewer words than a shingle (or null) can't be found, nor can a null or empty
    document hold one; rows of equal document id count as one document that holds what any of them holds; null
    ids are kept as an id of their own (an item's: larger than all others); empty tables give no rows.
    """
    n = shingle_words
    bench = items.select(
        F.coalesce(F.col(item_col).cast("long"), F.lit(_NULL_ID)).alias("__item"),
        F.col(item_text_col).cast("string").alias("__text"),
    )
    bench = computed(bench, "__words", folded_words("__text"), "__item").where(F.size("__words") >= n)
    bench = bench.groupBy("__words").agg(F.min("__item").alias("__item"))
    prepared = (
        computed(bench, "__shingles", shingle_texts("__words", n), "__item", "__words")
        .withColumn("__size", F.size("__shingles"))
        .withColumn("__need", F.ceil(F.round(F.col("__size") * threshold, 6)).cast("int"))
    )
    keyed = prepared.select(
        "__item",
        size_class("__size").alias("__class"),
        F.slice(
            F.array_sort(F.array_distinct(_shingle_hashes("__words", n))),
            F.lit(1),
            (F.col("__size") - F.col("__need") + 1).cast("int"),
        ).alias("__signature"),
    )
    # How far up the order the signatures of each class reach: a row per power of two.
    tops = keyed.groupBy("__class").agg(F.max(F.element_at("__signature", -1)).alias("__top")).collect()
    classes = F.array(
        *[F.struct(F.lit(r["__class"]).alias("__class"), F.lit(r["__top"]).alias("__top")) for r in tops]
    ).cast("array<struct<__class: int, __top: bigint>>")
    signatures = _small(keyed.select("__class", "__item", F.explode("__signature").alias("__key")))

    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("__id"),
        F.col(text_col).cast("string").alias("__text"),
    ).withColumn("__hash", F.xxhash64("__text"))
    # What lies above all ceilings is left out first, then what is above that of each class.
    highest = max((r["__top"] for r in tops), default=-(1 << 63))
    hashes = F.filter(_shingle_hashes("__words", n), lambda x: x <= F.lit(highest))
    keys = (
        computed(texts, "__words", folded_words("__text"), "__id", "__hash")
        .where(F.size("__words") >= n)
        .select("__id", "__hash", F.explode(F.array_distinct(hashes)).alias("__key"))
        .select("*", F.explode(F.filter(classes, lambda c: F.col("__key") <= c["__top"])["__class"]).alias("__class"))
    )
    met = keys.join(signatures, ["__class", "__key"]).select("__id", "__hash", "__item").distinct()
    path = scratch_path(docs.sparkSession, "candidates")
    met.write.parquet(path)
    candidates = _small(docs.sparkSession.read.parquet(path))

    # The text travels, if at all, not its shingles: they are made once more where document and item have met.
    whole = texts.join(candidates, ["__id", "__hash"]).select("__id", "__text", "__item")
    met = whole.join(prepared.select("__item", "__shingles", "__size", "__need"), "__item")
    passed = ["__id", "__item", "__size", "__need"]
    met = computed(met, "__words", folded_words("__text"), *passed, "__shingles")
    shared = F.size(F.array_intersect(shingle_texts("__words", n), "__shingles"))
    return (
        computed(met, "__shared", shared, *passed)
        .where("__shared >= __need")
        .groupBy("__id", "__item")
        .agg(F.max("__size").cast("long").alias("n_item_shingles"), F.max("__shared").cast("long").alias("n_shared"))
        .select(
            F.nullif("__id", F.lit(_NULL_ID)).alias(id_col),
            F.nullif("__item", F.lit(_NULL_ID)).alias(item_col),
            "n_item_shingles",
            "n_shared",
            (F.col("n_shared").cast("double") / F.col("n_item_shingles")).alias("containment"),
        )
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, unchanged, whose document holds no item; see :func:`contained_items`."""
    found = contained_items(docs, items, threshold, id_col=id_col, text_col=text_col)
    # A name that no column of the rows has, whatever they are called.
    name = "__held"
    while name in docs.columns:
        name += "_"
    held = found.select(F.col(id_col).alias(name)).distinct()
    return docs.join(held, docs[id_col].eqNullSafe(held[name]), "left_anti")
