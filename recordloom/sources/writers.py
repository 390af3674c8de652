"""Sinks and table maintenance over Parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the table."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add to the table."""
    df.write.mode("append").parquet(path)


def one_each(df: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One row for each key: the one last in order; without an order a key that repeats raises ValueError.
    Of rows equal in order the greatest in the columns' order stays."""
    if order is None:
        if not df.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"{list(keys)} repeats; name a column that orders its rows")
        return df
    rest = [c for c in df.columns if c not in (*keys, order)]
    return df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_r")).select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in df.columns])


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """All of delta, and the rows of base whose key it lacks; one row a key of delta, see one_each."""
    return base.join(delta, list(keys), "left_anti").unionByName(one_each(delta, keys, order))


def insert_new(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """base, and the rows of delta whose key it lacks; one row a key of delta, see one_each."""
    return base.unionByName(one_each(delta, keys, order).join(base, list(keys), "left_anti"))


def backfill(base: DataFrame, src: DataFrame, keys: Sequence[str], cols: Sequence[str], only_null: bool = True, order: str | None = None) -> DataFrame:
    """Chosen columns of base from src on a match, base's rows as they are; only_null leaves present
    values; one row a key of src, see one_each (K05)."""
    new = one_each(src, keys, order).select(*keys, *[F.col(c).alias(f"_{c}") for c in cols])
    first = lambda c: (F.col(c), F.col(f"_{c}")) if only_null else (F.col(f"_{c}"), F.col(c))
    joined = base.join(new, list(keys), "left")
    return joined.select(*[F.coalesce(*first(c)).alias(c) if c in cols else F.col(c) for c in base.columns])


def replace_partition(df: DataFrame, path: str, *cols: str) -> None:
    """Overwrite just the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def delete_where(df: DataFrame, predicate: Column, keys: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Rows for which predicate isn't true, or whose key is outside the scope."""
    gone = F.coalesce(predicate, F.lit(False))
    if keys is None:
        return df.filter(~gone)
    scope = keys.select(key).distinct().withColumn("_in", F.lit(True))
    return df.join(scope, key, "left").filter(~(gone & F.coalesce("_in", F.lit(False)))).drop("_in")


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int) -> None:
    """Ranges of the keys in separate, sorted files, so that scans can skip."""
    df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def compact(spark: SparkSession, path: str, to: str, files: int) -> None:
    """Rewrite a table of small files into few."""
    spark.read.parquet(path).coalesce(files).write.mode("overwrite").parquet(to)


def create_empty(spark: SparkSession, path: str, schema: str) -> None:
    """An empty table; refuses if something is there."""
    spark.createDataFrame([], schema).write.mode("error").parquet(path)


def publish(df: DataFrame, root: str, version: int, gates: Mapping[str, Callable[[DataFrame], bool]]) -> DataFrame:
    """Write aside, check, and only then point at the new version.

    Pointers are rows added to ``root/latest``, never overwritten: whatever breaks off before the row is
    committed leaves readers at the version before, and a broken-off version may be published again.
    """
    spark, path = df.sparkSession, f"{root}/v={version}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.parquet(path)
    failed = [name for name, gate in gates.items() if not gate(written)]
    if failed:
        raise ValueError(f"version {version} fails {', '.join(failed)}; latest stays")
    _point(spark, root, version, path)
    return written


POINTER = "number long, version int, path string"


def _pointers(spark: SparkSession, root: str) -> list:
    """All pointers of a root, the last one first."""
    try:
        return sorted(spark.read.schema(POINTER).parquet(f"{root}/latest").collect(), reverse=True)
    except AnalysisException:  # nothing is published yet
        return []


def _point(spark: SparkSession, root: str, version: int, path: str) -> None:
    number = next((p.number for p in _pointers(spark, root)), 0) + 1
    append(spark.createDataFrame([(number, version, path)], POINTER).coalesce(1), f"{root}/latest")


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(_pointers(spark, root)[0].path)


def restore(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Point at an earlier published version again."""
    path = next((p.path for p in _pointers(spark, root) if p.version == version), None)
    if path is None:
        raise ValueError(f"version {version} was never published")
    _point(spark, root, version, path)
    return read_latest(spark, root)


def record_run(spark: SparkSession, ledger: str, feed: str, run_at: str, rows: int, status: str) -> None:
    """One row per run."""
    row = spark.createDataFrame([(feed, run_at, rows, status)], "feed string, run_at string, n_rows long, status string")
    append(row.withColumn("run_at", F.col("run_at").cast("timestamp")), ledger)
