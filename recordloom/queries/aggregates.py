"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions.values import share
from recordloom.operators import aggregates as A

from .registry import query

YEAR = "year(o_orderdate)"


@query("g01_rollup", "select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity, min(l_extendedprice) as least, max(l_extendedprice) as most, round(avg(l_discount), 6) as discount from lineitem group by 1, 2")
def g01(t):
    return A.rollup(t.lineitem, ["l_returnflag", "l_linestatus"], n=F.count(F.lit(1)), quantity=F.round(F.sum("l_quantity"), 2), least=F.min("l_extendedprice"), most=F.max("l_extendedprice"), discount=F.round(F.avg("l_discount"), 6))


@query("g02_agg_if", "select o_custkey, round(coalesce(sum(o_totalprice) filter (where o_orderstatus = 'F'), 0), 2) as filled, count(*) filter (where o_orderstatus = 'O') as n_open from orders group by 1")
def g02(t):
    s = F.col("o_orderstatus")
    return A.rollup(t.orders, ["o_custkey"], filled=F.round(F.coalesce(A.agg_if(F.col("o_totalprice"), s == "F"), F.lit(0.0)), 2), n_open=A.agg_if(F.lit(1), s == "O", F.count))


@query("g03_count_distinct", "select l_returnflag, count(distinct l_partkey) as parts, count(distinct (l_partkey, l_suppkey)) as pairs from lineitem group by 1")
def g03(t):
    return A.rollup(t.lineitem, ["l_returnflag"], parts=F.count_distinct("l_partkey"), pairs=F.count_distinct("l_partkey", "l_suppkey"))


@query("g04_approx_distinct")
def g04(t):
    return A.rollup(t.events, ["event_type"], users=F.approx_count_distinct("user_id"))


@query("g05_latest_value", "select user_id, arg_max(event_type, (ts, event_id)) as event_type from events group by 1")
def g05(t):
    return A.latest_value(t.events, "user_id", "event_type", ["ts", "event_id"])


@query("g06_bool_or", "select user_id, bool_or(event_type = 'purchase') as bought, bool_and(value < 400) as modest from events group by 1")
def g06(t):
    return A.rollup(t.events, ["user_id"], bought=F.bool_or(F.col("event_type") == "purchase"), modest=F.every(F.col("value") < 400))


@query("g07_quantiles", "select o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) as p50, round(quantile_cont(o_totalprice, 0.9), 4) as p90 from orders group by 1")
def g07(t):
    q = A.quantiles(t.orders, ["o_orderpriority"], "o_totalprice", p50=0.5, p90=0.9)
    return q.select("o_orderpriority", F.round("p50", 4).alias("p50"), F.round("p90", 4).alias("p90"))


@query("g08_mode_by", "with n as (select o_custkey, o_orderpriority, count(*) as n from orders group by 1, 2) select o_custkey, o_orderpriority, n from (select *, row_number() over (partition by o_custkey order by n desc, o_orderpriority) as rn from n) where rn = 1")
def g08(t):
    return A.mode_by(t.orders, "o_custkey", "o_orderpriority")


@query("g09_collect", "select o_custkey, string_agg(distinct substr(o_orderpriority, 1, 1), ',' order by substr(o_orderpriority, 1, 1)) as p from orders group by 1")
def g09(t):
    return A.collect(t.orders.withColumn("p", F.substring("o_orderpriority", 1, 1)), "o_custkey", "p")


@query("g10_nest", "select l_orderkey, count(*) as n, string_agg(l_partkey || ':' || l_suppkey, ',' order by l_shipdate, l_linenumber, l_partkey, l_suppkey) as lines from lineitem group by 1")
def g10(t):
    nested = A.nest(t.lineitem, "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"], "lines")
    return nested.select("l_orderkey", F.size("lines").cast("long").alias("n"), F.array_join(F.transform("lines", lambda r: F.concat_ws(":", r["l_partkey"].cast("string"), r["l_suppkey"].cast("string"))), ",").alias("lines"))


@query("g11_top_n_nested", "with r as (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn, count(*) over (partition by o_custkey) as n from orders) select o_custkey, any_value(n) as n_orders, string_agg(o_orderkey, ',' order by rn) as orders from r where rn <= 3 group by 1")
def g11(t):
    top = A.top_n_nested(t.orders, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], ["o_orderkey"], 3, "orders")
    return top.select("o_custkey", "n_orders", F.array_join(F.transform("orders", lambda r: r["o_orderkey"].cast("string")), ",").alias("orders"))


@query("g12_trajectory_map", f"with p as (select o_custkey, {YEAR} as y, count(*) as v from orders group by 1, 2) select o_custkey, '{{' || string_agg('\"' || y || '\":' || v, ',' order by y) || '}}' as by_year from p group by 1")
def g12(t):
    return A.trajectory_map(t.orders.withColumn("y", F.year("o_orderdate")).withColumn("one", F.lit(1)), "o_custkey", "y", "one")


@query(
    "g13_windowed",
    "select o_custkey, "
    + ", ".join(f"round(sum(case when cast(o_orderdate as date) > date '1998-08-02' - interval {m} month then o_totalprice else 0 end), 2) as sum_{m}m, count(*) filter (where cast(o_orderdate as date) > date '1998-08-02' - interval {m} month) as n_{m}m" for m in (12, 24, 36))
    + ", round(sum(o_totalprice), 2) as sum_all, count(*) as n_all from orders where cast(o_orderdate as date) <= date '1998-08-02' group by 1",
)
def g13(t):
    return A.windowed(t.orders, "o_custkey", "o_orderdate", "o_totalprice", [12, 24, 36], "1998-08-02")


@query(
    "g14_growth",
    f"""with p as (select o_custkey, {YEAR} as y, sum(o_totalprice) as v from orders group by 1, 2), s as (select o_custkey, min(y) as first_year, max(y) as last_year, arg_min(v, y) as a, arg_max(v, y) as b from p group by 1)
    select o_custkey, first_year, last_year, case when last_year > first_year and a > 0 then round(pow(b / a, 1.0 / (last_year - first_year)) - 1, 6) end as cagr, round(b / nullif(p.v, 0) - 1, 6) as yoy from s left join p on p.o_custkey = s.o_custkey and p.y = last_year - 1""".replace("select o_custkey, first_year", "select s.o_custkey, first_year"),
)
def g14(t):
    g = A.growth(t.orders.withColumn("y", F.year("o_orderdate").cast("long")), "o_custkey", "y", "o_totalprice")
    return g


@query("g15_top_share", "with p as (select l_suppkey, l_partkey, sum(l_extendedprice) as v from lineitem group by 1, 2) select l_suppkey, l_partkey as top_partner, round(v / t, 6) as top_share, n as n_partners from (select *, row_number() over (partition by l_suppkey order by v desc, l_partkey) as rn, sum(v) over (partition by l_suppkey) as t, count(*) over (partition by l_suppkey) as n from p) where rn = 1")
def g15(t):
    return A.top_share(t.lineitem, "l_suppkey", "l_partkey", "l_extendedprice")


@query("g16_share", "select l_suppkey, round(sum(case when l_returnflag = 'R' then l_quantity else 0 end) / nullif(sum(l_quantity), 0), 6) as returned, round(count(*) filter (where l_returnflag = 'N') / nullif(count(*) filter (where l_linestatus = 'Z'), 0), 6) as none from lineitem group by 1")
def g16(t):
    r, z = F.col("l_returnflag"), F.col("l_linestatus")
    return A.rollup(t.lineitem, ["l_suppkey"], returned=F.round(share(F.sum(F.when(r == "R", F.col("l_quantity")).otherwise(0)), F.sum("l_quantity")), 6), none=F.round(share(F.count(F.when(r == "N", 1)), F.count(F.when(z == "Z", 1))), 6))


@query("g17_pivot_flags", "select user_id, " + ", ".join(f"count(*) filter (where event_type = '{e}') as n_{e}" for e in ("click", "view", "purchase")) + " from events group by 1")
def g17(t):
    return A.pivot_flags(t.events, "user_id", "event_type", ["click", "view", "purchase"])


@query("g18_bands", "select (o_totalprice >= 50000)::int + (o_totalprice >= 150000)::int + (o_totalprice >= 300000)::int as band, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1")
def g18(t):
    return A.bands(t.orders, "o_totalprice", [50000, 150000, 300000], "o_totalprice")


@query("g19_funnel", "select 1 as step, 'all' as name, count(*) as n, round(sum(o_totalprice), 2) as total from orders union all select 2, 'filled', count(*), round(sum(o_totalprice), 2) from orders where o_orderstatus = 'F' union all select 3, 'big', count(*), round(sum(o_totalprice), 2) from orders where o_orderstatus = 'F' and o_totalprice > 300000")
def g19(t):
    return A.funnel(t.orders, "o_totalprice", {"all": F.lit(True), "filled": F.col("o_orderstatus") == "F", "big": F.col("o_totalprice") > 300000})


@query("g20_month_rollup", "select o_orderstatus, cast(date_trunc('month', o_orderdate) as date) as month, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1, 2")
def g20(t):
    return A.month_rollup(t.orders, ["o_orderstatus"], "o_orderdate", "o_totalprice")


@query("g21_stack_grains", "select 'status' as grain, o_orderstatus as code, round(sum(o_totalprice), 2) as total, count(*) as n from orders group by 2 union all select 'status and priority', o_orderstatus || '|' || o_orderpriority, round(sum(o_totalprice), 2), count(*) from orders group by 2")
def g21(t):
    return A.stack_grains(t.orders, {"status": ["o_orderstatus"], "status and priority": ["o_orderstatus", "o_orderpriority"]}, "o_totalprice")


@query("g22_merge_rollups", "select k, coalesce(n_customers, 0) as n_customers, coalesce(n_suppliers, 0) as n_suppliers from (select c_nationkey as k, count(*) as n_customers from customer where c_nationkey > 3 group by 1) full join (select s_nationkey as k, count(*) as n_suppliers from supplier where s_nationkey < 20 group by 1) using (k)")
def g22(t):
    a = t.customer.filter("c_nationkey > 3").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_customers"))
    b = t.supplier.filter("s_nationkey < 20").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return A.merge_rollups("k", a, b)


@query("g23_allocate", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, o_totalprice * (l_quantity / sum(l_quantity) over (partition by l_orderkey)) as allocated from lineitem join orders on o_orderkey = l_orderkey")
def g23(t):
    lines = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    return A.allocate(lines, "l_orderkey", "o_totalprice", "l_quantity").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "allocated")


@query("g25_expiry_calendar", "select cast(date_trunc('month', l_shipdate) as date) as month, count(*) as n, round(sum(l_extendedprice), 2) as total from lineitem where cast(l_shipdate as date) >= date '1998-08-02' group by 1")
def g25(t):
    return A.expiry_calendar(t.lineitem, "l_shipdate", "l_extendedprice", "1998-08-02")


@query("g26_consensus", "select l_orderkey, min(l_returnflag) as l_returnflag from lineitem group by 1 having count(distinct l_returnflag) = 1")
def g26(t):
    return A.consensus(t.lineitem, "l_orderkey", "l_returnflag")
