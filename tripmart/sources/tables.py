"""Namespaces, tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("staging", "silver", "gold")


def ensure_layers(spark: SparkSession, layers: Sequence[str] = LAYERS, location: str | None = None) -> None:
    """Create the namespaces that do not exist yet, below ``location`` instead of the warehouse if it is given."""
    for layer in layers:
        where = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{where}")


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Replace (or append to) a table and return it as read back, cut off from its lineage."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def write_fact(df: DataFrame, name: str, partition: str, cluster: Sequence[str]) -> DataFrame:
    """Replace a table partitioned by one column and clustered inside each partition.

    Rebalancing by the partition column keeps the number of files low; AQE splits a partition value
    that holds far more rows than the others and merges small ones. Sorting by the cluster columns
    makes the row-group statistics selective on them.
    """
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, *cluster)
        .write.mode("overwrite")
        .format("parquet")
        .partitionBy(partition)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def write_bucketed(
    df: DataFrame, name: str, by: Sequence[str], sort: Sequence[str], buckets: int | None = None, path: str | None = None
) -> DataFrame:
    """Replace a table whose rows lie in buckets by ``by``, sorted by ``by`` and ``sort`` within each.

    Windows, aggregates and joins on ``by`` read it without an exchange. Put the slice of time among ``by`` where one key
    may hold much of the table: a bucket is read by one task. ``buckets`` should be no fewer than the shuffle
    partitions, which is the default; with fewer, the planner may prefer to shuffle.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt to buckets by one shuffle, so that each is written by one task as one file.
    rows = df.repartition(buckets, *by).sortWithinPartitions(*by, *sort)
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by, *sort)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Name lazy DataFrames as views; they are computed when read."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
