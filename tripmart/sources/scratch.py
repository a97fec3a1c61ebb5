"""A place for files that only live as long as a job: checkpoints, landed test streams, round trips."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
#: For a session of one process only, which has no other machines to share files with.
_LOCAL_FOLDER = "/tmp/checkpoints"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder all executors share.

    The session names that folder in ``spark.checkpoint.dir``. Without the setting, a session whose driver
    and executor are one process uses ``/tmp/checkpoints``; any cluster, also a local one, must set it.
    """
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder that all executors can reach")
        base = _LOCAL_FOLDER
    return f"{base.rstrip('/')}/tripmart/{purpose}-{uuid.uuid4().hex}"
