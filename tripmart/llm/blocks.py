"""All-pairs comparison of a large group, dealt over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, group: str, member: str, count: str, most: int) -> DataFrame:
    """Deal each group into blocks of about ``most`` rows; a row goes to every pair of blocks that has its own.

    ``count`` holds the size of the row's group. Adds ``__pair`` (hash of group and pair of blocks) and ``__side``:
    0 where the pair is a block with itself, else 1 or 2 for the two blocks, whose rows meet only across.
    """
    blocks = F.ceil(F.col(count) / most)
    dealt = rows.withColumn("__own", F.pmod(F.xxhash64(member), blocks)).select(
        "*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("__other")
    )
    low, high = F.least("__own", "__other"), F.greatest("__own", "__other")
    side = F.when(F.col("__own") == F.col("__other"), 0).when(F.col("__own") == low, 1).otherwise(2)
    return dealt.select("*", F.xxhash64(group, low, high).alias("__pair"), side.cast("int").alias("__side"))
