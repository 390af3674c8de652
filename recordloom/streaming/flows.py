"""Continuous flows as Structured Streaming.

Every flow takes a streaming DataFrame. Sinks write through ``foreachBatch`` and are idempotent: a
batch that runs again after a failure replaces what it wrote.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

def read_files(spark: SparkSession, path: str, schema, per_batch: int = 1) -> DataFrame:
    """Files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def inbox(stream: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """Payload rows once per delivery id within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-only file sink over all that is available."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


# A keyed table kept as runs. A batch writes its own rows as one run. Runs are of a level by their rows, in
# powers of FAN, and FAN runs of a level are merged into one: a row is written again once a level, never with
# each batch. A log entry a batch, written last, names the live runs. A batch that is run again starts from
# the entry before its own.
FAN = 8


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _drop(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


def _log(spark: SparkSession, root: str, before: int | None = None) -> dict:
    """The last entry under a root, or the last before a batch: live runs oldest first, times, keys."""
    at, fs = _path(spark, f"{root}/_log")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    done = [int(n[:-5]) for n in names if n.endswith(".json") and (before is None or int(n[:-5]) < before)]
    if not done:
        return {"batch": -1, "runs": [], "last": None}
    return json.loads(spark.read.text(f"{root}/_log/{max(done):012d}.json", wholetext=True).first()[0])


def _commit(spark: SparkSession, root: str, entry: dict) -> None:
    """Write an entry aside, then move it to its place; entries before the last two go."""
    done, fs = _path(spark, f"{root}/_log/{entry['batch']:012d}.json")
    aside, _ = _path(spark, f"{root}/_log/{entry['batch']:012d}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    fs.delete(done, False)
    if not fs.rename(aside, done):
        raise OSError(f"{done} was not written")
    _drop(spark, f"{root}/_log/{entry['batch'] - 2:012d}.json")


def _latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key, the last in the order (nulls first), by aggregates that combine before the shuffle."""
    best = F.max(F.struct(F.struct(*order).alias("o"), F.struct(*rows.columns).alias("r")))
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best["r"].alias("r")).select("r.*")


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_{k}"]) for k in keys])


def _merged(spark: SparkSession, root: str, runs: Sequence[dict], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key over runs. Rows of the largest that no other run has pass without a shuffle
    where the others are small enough for Spark to broadcast."""
    first, *rest = sorted(runs, key=lambda r: -r["level"])
    base = spark.read.parquet(f"{root}/{first['path']}")
    if not rest:
        return base
    news = reduce(DataFrame.unionByName, [spark.read.parquet(f"{root}/{r['path']}") for r in rest])
    changed = news.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    met = _same(base, changed, keys)
    return base.join(changed, met, "left_anti").unionByName(_latest(base.join(changed, met, "left_semi").unionByName(news), keys, order))


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The table as of its last batch; None before the first."""
    entry = _log(spark, root)
    return _merged(spark, root, entry["runs"], entry["keys"], entry["order"]) if entry["runs"] else None


def newer(landed: DataFrame, incoming: DataFrame, ts: str, keys: Sequence[str]) -> DataFrame:
    """Rows of an overlapping pull past the last time landed, and those of that time that have not landed;
    all if nothing has (Z02)."""
    last = landed.agg(F.max(ts).alias("_last"))  # one row
    own = incoming.crossJoin(F.broadcast(last)).filter(F.col("_last").isNull() | (F.col(ts) >= F.col("_last")))
    ties = landed.join(F.broadcast(last), F.col(ts) == F.col("_last")).select(*[F.col(c).alias(f"_{c}") for c in {*keys, ts}])
    return own.join(ties, _same(own, ties, [*{*keys, ts}]), "left_anti").drop("_last")


def upsert(batch: DataFrame, number: int, root: str, keys: Sequence[str], order: Sequence[str], since: str | None = None, fan: int = FAN) -> None:
    """Merge one batch into the table of runs; with ``since``, only what is newer by that column."""
    spark = batch.sparkSession
    before = _log(spark, root, number)
    rows = batch
    if since and before["last"] is not None:
        kind = batch.schema[since].dataType
        rows = rows.filter(F.col(since) >= F.lit(before["last"]).cast(kind))
        landed = _merged(spark, root, before["runs"], keys, order).filter(F.col(since) == F.lit(before["last"]).cast(kind))
        ties = landed.select(*[F.col(c).alias(f"_{c}") for c in {*keys, since}])
        rows = rows.join(ties, _same(rows, ties, [*{*keys, since}]), "left_anti")
    last, made = before["last"], 0

    def written(df: DataFrame) -> dict:
        """A run, its level by its rows: powers of fan."""
        nonlocal made
        path, made = f"runs/{number}-{made}", made + 1
        df.write.mode("overwrite").parquet(f"{root}/{path}")
        rows, level = spark.read.parquet(f"{root}/{path}").count(), 0
        while rows >= fan ** (level + 1):
            level += 1
        return {"path": path, "level": level}

    runs = [*before["runs"], written(_latest(rows, keys, order))]
    if since:
        top = spark.read.parquet(f"{root}/{runs[-1]['path']}").agg(F.max(since).cast("string")).first()[0]
        last = top if top is not None else last
    while same := next((x for x in ([r for r in runs if r["level"] == n] for n in {r["level"] for r in runs}) if len(x) >= fan), None):
        runs = [r for r in runs if r not in same] + [written(_merged(spark, root, same, keys, order))]
    _commit(spark, root, {"batch": number, "runs": runs, "last": last, "keys": list(keys), "order": list(order)})
    kept = {r["path"] for r in [*runs, *before["runs"]]}  # those of the entry before serve a batch that is run again
    for gone in _listed(spark, f"{root}/runs"):
        if f"runs/{gone}" not in kept:
            _drop(spark, f"{root}/runs/{gone}")


def _listed(spark: SparkSession, path: str) -> list[str]:
    at, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)]


def incremental_upsert(stream: DataFrame, root: str, checkpoint: str, key: str, order: Sequence[str], deleted: str | None = None, since: str | None = None) -> StreamingQuery:
    """Latest row per key, kept up batch by batch (Z02, Z04): newer rows replace older ones, late older rows lose.

    What a batch writes follows the batch: its own rows, and each row once more a level (``FAN``). With
    ``since`` each batch first reads the last time landed and takes what is newer, so pulls may overlap. With
    ``deleted``, rows marked so stay in the table and read_live leaves them out.
    """
    if deleted is not None and deleted not in stream.columns:
        raise ValueError(f"the stream has no column {deleted}")

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch, number, root, [key], order, since)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_live(spark: SparkSession, root: str, deleted: str) -> DataFrame:
    """A projection without soft-deleted rows."""
    return read_table(spark, root).filter(~F.coalesce(F.col(deleted), F.lit(False)))


def latest_view(landed: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Latest-wins reading of an append-only landing with late rows and re-deliveries."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return landed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def stream_rollup(stream: DataFrame, ts: str, key: str, measure: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Sum and count by key and event-time window."""
    grouped = stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), key)
    return grouped.agg(F.sum(measure).alias("total"), F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), "total", "n")


def rollup_table(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str]) -> StreamingQuery:
    """Update-mode rollup kept as a table of runs: the last value of each key and window."""

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch.withColumn("_batch", F.lit(number)), number, root, keys, ["_batch"])

    return stream.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
