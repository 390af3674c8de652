"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
_OWN: ContextVar[list[str] | None] = ContextVar("tables of the run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where it is unset on a local
    master (tests), where all tasks share the machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return _LOCAL[0]


def cut(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: the plan starts anew, and a
    lost executor loses nothing."""
    path = f"{shared_dir(df.sparkSession)}/recordloom/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    own = _OWN.get()
    if own is not None:
        own.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tracked() -> Iterator[list[str]]:
    """The tables that cut() writes meanwhile, for this run alone: other threads have lists of their own. Give
    them to remove() once what reads them is written."""
    own: list[str] = []
    before = _OWN.set(own)
    try:
        yield own
    finally:
        _OWN.reset(before)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written folders that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free(name: str, taken: list[str]) -> str:
    """name, or with underscores before it so that no column of ``taken`` has it."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name
