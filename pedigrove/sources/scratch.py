"""A folder for tables between steps, which all executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares: spark.checkpoint.dir, or what the caller gave to setCheckpointDir.

    Without either, a session on one machine (tests) takes a temporary folder; on a
    cluster it is an error, as such a folder would lie on single machines.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and re.fullmatch(r"local(\[.*\])?", sc.master):
            folder = tempfile.mkdtemp(prefix="spark-")
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder)
        current = sc.getCheckpointDir()
    return current


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
