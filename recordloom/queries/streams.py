"""Streaming flows over the events, delivered as files."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.sources.scratch import folder
from recordloom.streaming import flows as Z

from .registry import query


def _delivered(t, again: bool = False):
    """The events as a stream of files by time range; with again, every third event once more."""
    path = folder(t.spark)
    own = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    own = own.union(own.filter("event_id % 3 = 0")) if again else own
    for start in range(1, 32, 8):  # one delivery after the other, as they come
        own.filter(F.dayofmonth("ts").between(start, start + 7)).sortWithinPartitions("ts").coalesce(1).write.mode("append").parquet(path)
    return Z.read_files(t.spark, path, own.schema)


@query("z01_inbox", "select event_id, user_id from events")
def z01(t):
    out = folder(t.spark)
    Z.append_to(Z.inbox(_delivered(t, True), "event_id", "ts").select("event_id", "user_id"), out, folder(t.spark)).awaitTermination()
    return t.spark.read.parquet(out)


LATEST = "select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type from events group by 1"


@query("z02_incremental_upsert", LATEST)
def z02(t):
    root = folder(t.spark)
    Z.incremental_upsert(_delivered(t), root, folder(t.spark), "user_id", ["ts", "event_id"], since="ts").awaitTermination()
    return Z.read_table(t.spark, root).select("user_id", "event_id", "event_type")


@query("z02_newer", "select event_id, user_id from events where ts > (select max(ts) from events where ts < timestamp '2024-01-16')")
def z02_newer(t):
    """A pull that overlaps what has landed by six days."""
    return Z.newer(t.events.filter("ts < '2024-01-16'"), t.events.filter("ts >= '2024-01-10'"), "ts", ["event_id"]).select("event_id", "user_id")


@query("z03_append_then_latest", LATEST)
def z03(t):
    out = folder(t.spark)
    Z.append_to(_delivered(t, True), out, folder(t.spark)).awaitTermination()
    return Z.latest_view(t.spark.read.parquet(out), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("z04_project_latest", f"select user_id, event_id from ({LATEST}) where event_type <> 'error'")
def z04(t):
    root = folder(t.spark)
    marked = _delivered(t).withColumn("deleted", F.col("event_type") == "error")
    Z.incremental_upsert(marked, root, folder(t.spark), "user_id", ["ts", "event_id"], "deleted").awaitTermination()
    return Z.read_live(t.spark, root, "deleted").select("user_id", "event_id")


@query("z05_stream_rollup", "select event_type, cast(ts as date) as day, round(sum(value), 2) as total, count(*) as n from events group by 1, 2")
def z05(t):
    root = folder(t.spark)
    Z.rollup_table(Z.stream_rollup(_delivered(t), "ts", "event_type", "value"), root, folder(t.spark), ["event_type", "start"]).awaitTermination()
    return Z.read_table(t.spark, root).select("event_type", F.col("start").cast("date").alias("day"), F.round("total", 2).alias("total"), "n")
