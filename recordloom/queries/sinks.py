"""Sinks and table maintenance, round trips."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recordloom.functions.geo import zorder_key
from recordloom.sources import writers as W
from recordloom.sources.scratch import folder

from .registry import query

HALF = "select o_orderkey, o_custkey, o_totalprice * 2 as o_totalprice from orders where o_orderkey % 2 = 0"


def _base(t):
    return t.orders.filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", "o_totalprice")


def _delta(t):
    return t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))


@query("k01_write_snapshot", "select n_nationkey, n_name from nation where n_nationkey % 2 = 0")
def k01(t):
    path = folder(t.spark)
    W.write_snapshot(t.nation.select("n_nationkey", "n_name"), path)
    W.write_snapshot(t.nation.filter("n_nationkey % 2 = 0").select("n_nationkey", "n_name"), path)
    return t.spark.read.parquet(path)


@query("k02_append", "select o_orderkey from orders union all select o_orderkey from orders where o_orderkey % 5 = 0")
def k02(t):
    path = folder(t.spark)
    W.append(t.orders.select("o_orderkey"), path)
    W.append(t.orders.filter("o_orderkey % 5 = 0").select("o_orderkey"), path)
    return t.spark.read.parquet(path)


@query("k03_upsert", f"select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 3 <> 0 and o_orderkey % 2 <> 0 union all {HALF}")
def k03(t):
    return W.upsert(_base(t), _delta(t), ["o_orderkey"])


@query(
    "k03_upsert_latest",
    "select o_custkey, last_day, o_orderkey from (select o_custkey, cast(o_orderdate as date) as last_day, o_orderkey, row_number() over (partition by o_custkey order by cast(o_orderdate as date) desc, o_orderkey desc) as rn from orders) where rn = 1 union all select c_custkey, null, null from customer where c_custkey not in (select o_custkey from orders)",
)
def k03_latest(t):
    """A delta with many rows a key: the last one stays."""
    base = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.lit(None).cast("date").alias("last_day"), F.lit(None).cast("long").alias("o_orderkey"))
    delta = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("last_day"), "o_orderkey")
    return W.upsert(base, delta, ["o_custkey"], order="last_day")


@query("k04_insert_new", f"select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 3 <> 0 union all {HALF} and o_orderkey % 3 = 0")
def k04(t):
    return W.insert_new(_base(t), _delta(t), ["o_orderkey"])


@query("k05_backfill", "select c_custkey, coalesce(case when c_custkey % 3 <> 0 then c_mktsegment end, case when c_custkey % 2 = 0 then 'S' || c_nationkey end) as c_mktsegment from customer")
def k05(t):
    base = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    src = t.customer.filter("c_custkey % 2 = 0").select("c_custkey", F.concat(F.lit("S"), F.col("c_nationkey")).alias("c_mktsegment"))
    return W.backfill(base, src, ["c_custkey"], ["c_mktsegment"])


@query("k06_replace_partition", "select o_orderkey, o_custkey + (case when year(o_orderdate) = 1998 then 1 else 0 end) as o_custkey, year(o_orderdate) as y from orders")
def k06(t):
    path = folder(t.spark)
    own = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    W.replace_partition(own, path, "y")
    W.replace_partition(own.filter("y = 1998").withColumn("o_custkey", F.col("o_custkey") + 1), path, "y")
    return t.spark.read.parquet(path).select("o_orderkey", "o_custkey", F.col("y").cast("long").alias("y"))


@query("k07_delete_where", "select o_orderkey from orders where not (o_orderstatus = 'F' and o_custkey in (select c_custkey from customer where c_nationkey < 5))")
def k07(t):
    scope = t.customer.filter("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"))
    return W.delete_where(t.orders, F.col("o_orderstatus") == "F", scope, "o_custkey").select("o_orderkey")


@query("k08_write_clustered", "select o_custkey, count(*) as n from orders group by 1")
def k08(t):
    path = folder(t.spark)
    W.write_clustered(t.orders.select("o_custkey", "o_orderkey"), path, ["o_custkey", "o_orderkey"], 4)
    return t.spark.read.parquet(path).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


LAT, LON = "25 + ((c_custkey * 7919) % 2500) / 100.0", "-124 + ((c_custkey * 104729) % 5700) / 100.0"


@query(
    "k09_zorder_key",
    f"""with p as (select c_custkey, cast(floor(({LAT} + 90) / 180 * 255) as bigint) as y, cast(floor(({LON} + 180) / 360 * 255) as bigint) as x from customer)
    select c_custkey, {' + '.join(f'((x >> {i}) & 1) * {1 << (2 * i)} + ((y >> {i}) & 1) * {1 << (2 * i + 1)}' for i in range(8))} as z from p""",
)
def k09(t):
    return t.customer.select("c_custkey", zorder_key(F.expr(f"cast({LAT} as double)"), F.expr(f"cast({LON} as double)"), 8).alias("z"))


@query("k10_compact", "select count(*) as n, count(distinct o_orderkey) as keys from orders")
def k10(t):
    a, b = folder(t.spark), folder(t.spark)
    t.orders.select("o_orderkey").repartition(16).write.parquet(a)
    W.compact(t.spark, a, b, 2)
    return t.spark.read.parquet(b).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("keys"))


@query("k11_create_empty", "select o_orderkey, o_orderstatus from orders")
def k11(t):
    """An empty table of a frozen schema, which a second attempt leaves alone, then filled."""
    path, own = folder(t.spark), t.orders.select("o_orderkey", "o_orderstatus")
    W.create_empty(t.spark, path, "o_orderkey long, o_orderstatus string")
    try:
        W.create_empty(t.spark, path, "other string")
    except AnalysisException:
        pass  # refused, as it should be
    W.append(own, path)
    return t.spark.read.schema("o_orderkey long, o_orderstatus string").parquet(path)


@query("k12_publish", "select o_orderkey, o_custkey from orders where o_orderkey % 2 = 0")
def k12(t):
    root = folder(t.spark)
    own = t.orders.select("o_orderkey", "o_custkey")
    W.publish(own.filter("o_orderkey % 2 = 0"), root, 1, {"rows": lambda d: not d.isEmpty()})
    try:
        W.publish(own.filter("o_orderkey < 0"), root, 2, {"rows": lambda d: not d.isEmpty()})
    except ValueError:
        pass  # the empty version fails its gate, and latest stays at version 1
    W.publish(own.filter("o_orderkey % 2 = 1"), root, 3, {})
    return W.restore(t.spark, root, 1)


@query("k13_record_run", "select 'orders' as feed, count(*) as n_rows, 'ok' as status from orders union all select 'events', count(*), 'ok' from events")
def k13(t):
    ledger = folder(t.spark)
    W.record_run(t.spark, ledger, "orders", "2024-01-01", t.orders.count(), "ok")
    W.record_run(t.spark, ledger, "events", "2024-01-02", t.events.count(), "ok")
    return t.spark.read.parquet(ledger).select("feed", "n_rows", "status")
