"""Session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "tripmart", master: str | None = None, shuffle_partitions: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above.

    ``shuffle_partitions`` is the upper bound that AQE coalesces from: about the number of cores on a
    laptop, and total shuffle bytes / 128 MB on a cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **extra}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
