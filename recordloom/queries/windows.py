"""Window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import windows as W

from .registry import query

ORDER = ["ts", "event_id"]


@query("w01_latest_per_key", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by case when o_orderkey % 5 <> 0 then o_orderdate end desc nulls last, o_orderkey) as rn from orders) where rn = 1")
def w01(t):
    own = t.orders.withColumn("d", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")))
    return W.latest_per_key(own, ["o_custkey"], [F.col("d").desc_nulls_last(), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("w02_rank_share", "with p as (select l_suppkey, l_partkey, sum(l_quantity) as q from lineitem group by 1, 2) select l_suppkey, l_partkey, rank() over (partition by l_suppkey order by q desc, l_partkey) as rank, round(q / sum(q) over (partition by l_suppkey), 6) as share from p")
def w02(t):
    p = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    return W.rank_share(p, "l_suppkey", "q", "l_partkey").select("l_suppkey", "l_partkey", F.col("rank").cast("long").alias("rank"), "share")


@query("w03_top_n", "select o_custkey, o_orderkey, rank from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders) where rank <= 3")
def w03(t):
    return W.top_n(t.orders, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", F.col("rank").cast("long").alias("rank"))


@query("w04_ladder_delta", "select event_id, round(value - lag(value) over w, 2) as d_value, date_diff('day', lag(ts) over w, ts) as days_ts from events window w as (partition by user_id order by ts, event_id)")
def w04(t):
    return W.ladder_delta(t.events, "user_id", ORDER, ["value"], ["ts"]).select("event_id", "d_value", F.col("days_ts").cast("long").alias("days_ts"))


@query("w05_changed_fields", "select o_orderkey, case when lag(o_orderkey) over w is not null then concat_ws(',', case when o_orderstatus is distinct from lag(o_orderstatus) over w then 'o_orderstatus' end, case when o_orderpriority is distinct from lag(o_orderpriority) over w then 'o_orderpriority' end) end as changed from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)")
def w05(t):
    return W.changed_fields(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderpriority"]).select("o_orderkey", "changed")


@query("w06_succession", "select event_id, p as predecessor, event_type as successor from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as p from events) where p is not null and p <> event_type")
def w06(t):
    return W.succession(t.events, "user_id", ORDER, "event_type").select("event_id", "predecessor", "successor")


SMOOTH = """with a as (select *, lag(event_type) over w as b, lead(event_type) over w as n from events window w as (partition by user_id order by ts, event_id)),
v as (select *, case when b is not null and b is not distinct from n then b else event_type end as v from a),
i as (select *, sum(case when v is distinct from pv then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as island from (select *, lag(v) over (partition by user_id order by ts, event_id) as pv from v))"""


@query("w07_islands", f"{SMOOTH} select event_id, cast(island as bigint) as island from i")
def w07(t):
    return W.islands(t.events, "user_id", ORDER, ["event_type"]).select("event_id", "island")


@query(
    "w08_scd2",
    f"""{SMOOTH}, g as (select user_id, cast(island as bigint) as version, min(ts) as valid_from, count(*) as n_rows, arg_max(event_type, (ts, event_id)) filter (where event_type = v) as event_type from i group by 1, 2)
    select user_id, version, valid_from, lead(valid_from) over (partition by user_id order by version) as valid_to, lead(valid_from) over (partition by user_id order by version) is null as is_current, n_rows, event_type from g""",
)
def w08(t):
    return W.scd2(t.events, "user_id", ORDER, ["event_type"], "ts")


@query("w09_last_known", "select event_id, (select arg_max(x.value, (x.ts, x.event_id)) from events x where x.user_id = e.user_id and x.event_type = 'purchase') as last_v from events e")
def w09(t):
    own = t.events.withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return W.last_known(own, "user_id", [F.desc("ts"), F.desc("event_id")], "v").select("event_id", "last_v")


@query("w10_canonical_id", "select c_custkey, min(c_custkey) over w as canonical_id, count(*) over w as group_size, c_custkey = min(c_custkey) over w as is_canonical from customer window w as (partition by c_nationkey * 100 + c_custkey % 10)")
def w10(t):
    return W.canonical_id(t.customer.withColumn("b", F.col("c_nationkey") * 100 + F.col("c_custkey") % 10), "b", "c_custkey").select("c_custkey", "canonical_id", "group_size", "is_canonical")


@query("w11_with_totals", "select o_orderkey, round(sum(o_totalprice) over w, 2) as group_total, count(*) over w as group_n, o_totalprice = max(o_totalprice) over w as is_largest from orders window w as (partition by o_custkey)")
def w11(t):
    return W.with_totals(t.orders, "o_custkey", "o_totalprice").select("o_orderkey", "group_total", "group_n", "is_largest")


@query("w12_percentile_in", "select c_custkey, round(percent_rank() over w, 6) as percent_rank, round(cume_dist() over w, 6) as cume_dist from customer window w as (partition by c_mktsegment order by c_acctbal)")
def w12(t):
    return W.percentile_in(t.customer, ["c_mktsegment"], "c_acctbal").select("c_custkey", "percent_rank", "cume_dist")


@query("w13_tenure", "with d as (select user_id, cast(ts as date) as day, bool_or(event_type = 'purchase') as active from events group by 1, 2) select user_id, min(day) as first_seen, max(day) as last_seen, count(distinct day) as n_seen, bool_or(not active) as ever_inactive, arg_max(active, day) as active_last from d group by 1")
def w13(t):
    d = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.bool_or(F.col("event_type") == "purchase").alias("active"))
    return W.tenure(d, "user_id", "day", F.col("active"))
