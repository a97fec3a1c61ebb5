"""A pipeline over ``documents``: language ID, near-dedup, substring dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; :func:`run` writes it as Parquet into the shared
scratch folder and rereads it as the next stage's ``docs``, so a lost executor costs no earlier stage. All but
the last give the columns of ``documents``. Stages work on whole texts of all rows that are left, and drop rows, not
ids: where ``doc_id`` is null or repeated, each row stands for itself (:func:`row_key`).

* language ID drops documents that the calibrated models reject (no text, no letter, none of the languages);
* near-dedup keeps the row of least id (null last) of each group linked by 80 percent of 5-word shingles;
* substring dedup cuts repeats of at least 50 words from all documents but the first, with the white space
  around them left as it is, and drops documents of which nothing is left;
* decontamination drops rows that hold 80 percent of a benchmark item's 5-word shingles;
* packing gives the pieces of sequences of 4096 ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.decontaminate import decontaminate
from tripmart.llm.langid import identify, train
from tripmart.llm.neardup import near_duplicates
from tripmart.llm.packing import pack
from tripmart.llm.queries import held_out
from tripmart.llm.substring import remove_repeats
from tripmart.sources.scratch import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs.where(~held_out()))
    return identify(docs, model, keep=COLUMNS).where("NOT rejected").select(*COLUMNS)


def row_key() -> Column:
    """A stable key of a row, by its id and text, of 64 bits: of ten billion rows a few pairs share one."""
    return F.xxhash64("doc_id", "text")


def second_key() -> Column:
    """Another 64 bits of the same: rows that agree in both keys are copies."""
    return F.xxhash64(F.lit("second"), "text", "doc_id")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of equal id and text are copies; one of them stays. Rows of equal id and other texts are not linked."""
    rows = docs.select(*COLUMNS).withColumns({"__row": row_key(), "__second": second_key()})
    found = near_duplicates(rows, shingle_words=5, percent=80, id_col="__row").select("__row", "component_id")
    # The null id counts as larger than all others; of equal ids the least key stays.
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    kept = (
        rows.select("__row", "doc_id")
        .join(found.distinct().hint("shuffle_hash"), "__row")
        .groupBy("component_id")
        .agg(F.min(first).alias("__first"))
        .select(F.col("__first.__row").alias("__row"))
    )
    left = rows.join(kept.hint("shuffle_hash"), "__row", "left_semi")
    return left.dropDuplicates(["__row", "__second"]).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = remove_repeats(docs, min_words=50, separator=None, carry=("lang", "source"))
    left = out.where("n_removed = 0 OR n_removed < n_words")
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS).withColumn("__row", row_key())
    return decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="__row").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: Language models and tokenizers are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one, read from its table."""
    base = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
