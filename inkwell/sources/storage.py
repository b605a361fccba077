"""Folders that every executor reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; on a cluster, whose
    executors would not share it, its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    if base is None:
        base = tempfile.mkdtemp(prefix="inkwell-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(data: DataFrame, purpose: str = "rows") -> DataFrame:
    """``data`` written once to the shared folder: computed once however often it is read, and its row ids stay the same."""
    path = shared_folder(data.sparkSession, purpose)
    data.write.parquet(path)
    return data.sparkSession.read.schema(data.schema).parquet(path)
