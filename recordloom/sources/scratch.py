"""Folders that all executors share, for tables a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def folder(spark: SparkSession) -> str:
    """A new path under the cluster's ``spark.checkpoint.dir``; a temporary one only where it is unset
    on a local master, where all tasks share the machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        root = _LOCAL[0]
    return f"{root}/recordloom/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df by way of a written table, which survives lost executors."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
