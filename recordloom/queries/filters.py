"""The predicate layer over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import values as V
from recordloom.operators import predicates as P

from .registry import query

REGISTRY = {"status": ("o_orderstatus", "string"), "priority": ("o_orderpriority", "string"), "price": ("o_totalprice", "number"), "day": ("o_orderdate", "date")}


@query("f01_compile_filters", "select o_orderkey from orders where o_orderstatus in ('F', 'O') and o_totalprice between 100000 and 200000 and o_orderpriority like '1%' and cast(o_orderdate as date) > date '1998-08-02' - interval 24 month and cast(o_orderdate as date) <= date '1998-08-02'")
def f01(t):
    where = P.compile_filters(
        [
            {"field": "status", "op": "in", "value": ["F", "O"]},
            {"field": "price", "op": "range", "value": [100000, 200000]},
            {"field": "priority", "op": "prefix", "value": "1"},
            {"field": "day", "op": "last_months", "value": {"as_of": "1998-08-02", "months": 24}},
        ],
        REGISTRY,
    )
    return t.orders.filter(where).select("o_orderkey")


@query("f02_code_match", "select p_partkey from part where p_type in ('PROMO') or p_type like 'S%' or p_type like 'EC%'")
def f02(t):
    return t.part.filter(V.code_match(F.col("p_type"), ["PROMO"], ["S", "EC"])).select("p_partkey")


@query("f03_band", "select o_orderkey from orders where o_totalprice >= 50000 and o_totalprice <= 90000")
def f03(t):
    return t.orders.filter(V.band(F.col("o_totalprice"), 50000, 90000)).select("o_orderkey")


@query("f04_within", "select o_orderkey, cast(o_orderdate as date) > date '1998-08-02' as ahead from orders where (cast(o_orderdate as date) > date '1998-08-02' - interval 3 month and cast(o_orderdate as date) <= date '1998-08-02') or (cast(o_orderdate as date) >= date '1998-08-02' and cast(o_orderdate as date) <= date '1998-08-02' + interval 90 day)")
def f04(t):
    d = F.col("o_orderdate")
    return t.orders.filter(V.within(d, "1998-08-02", months_back=3) | V.within(d, "1998-08-02", days_ahead=90)).select("o_orderkey", (d.cast("date") > F.to_date(F.lit("1998-08-02"))).alias("ahead"))


@query("f05_having_band", "select o_custkey, round(sum(o_totalprice), 2) as total from orders where year(cast(o_orderdate as date) + interval 3 month) = 1998 group by 1 having sum(o_totalprice) between 200000 and 600000")
def f05(t):
    return P.having_band(t.orders, "o_custkey", "o_totalprice", 200000, 600000, V.fiscal_year(F.col("o_orderdate")) == 1998).withColumn("total", F.round("total", 2))


def _legs(t):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return orders.filter("o_totalprice > 450000"), orders.filter("o_orderpriority = '1-URGENT'"), orders.filter("o_orderstatus = 'P'")


@query("f06_entities_where", "select distinct o_custkey as c_custkey from orders where o_totalprice > 450000 intersect select o_custkey from orders where o_orderpriority = '1-URGENT' except select o_custkey from orders where o_orderstatus = 'P' and o_totalprice > 480000")
def f06(t):
    big, urgent, pending = _legs(t)
    return P.entities_where(t.customer, "c_custkey", [big, urgent], [pending.filter("o_totalprice > 480000")])


@query("f06_entities_where_exclusions", "select c_custkey from customer except select o_custkey from orders where o_totalprice > 450000")
def f06_exclusions(t):
    return P.entities_where(t.customer, "c_custkey", [], [_legs(t)[0]])


@query("f07_collapse_then_filter", "select c_custkey, c_name from customer where c_nationkey < 10 and c_custkey in (select o_custkey from orders where o_totalprice > 400000 and cast(o_orderdate as date) >= date '1998-01-01')")
def f07(t):
    facts = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return P.collapse_then_filter(facts, "c_custkey", (F.col("o_totalprice") > 400000) & (F.col("o_orderdate") >= "1998-01-01"), t.customer, F.col("c_nationkey") < 10).select("c_custkey", "c_name")


@query("f08_lookup", "select i.position, i.c_custkey, c_name, c_name is not null as found from (values (0, 7), (1, 3), (2, 99999999), (3, 42)) i(position, c_custkey) left join customer c on c.c_custkey = i.c_custkey")
def f08(t):
    return P.lookup(t.customer, "c_custkey", [7, 3, 99999999, 42]).select("position", "c_custkey", "c_name", "found")


@query("f09_hydrate", "select c_custkey, c_name, n_orders, total from (select o_custkey as c_custkey, count(*) as n_orders from orders group by 1 order by 2 desc, 1 limit 25) join customer using (c_custkey) left join (select o_custkey as c_custkey, round(sum(o_totalprice), 2) as total from orders group by 1) using (c_custkey)")
def f09(t):
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
    top = per.agg(F.count(F.lit(1)).alias("n_orders")).orderBy(F.desc("n_orders"), "c_custkey").limit(25)
    return P.hydrate(top, "c_custkey", t.customer.select("c_custkey", "c_name"), per.agg(F.round(F.sum("o_totalprice"), 2).alias("total")))


@query("f10_code_search", "with c as (select p_brand, p_type, count(*) as n from part where lower(p_brand) like '%brand#1%' or lower(p_type) like '%brand#1%' group by 1, 2) select p_brand, arg_min(p_type, (-n, p_type)) as name, sum(n)::bigint as n from c group by 1")
def f10(t):
    return P.code_search(t.part, "p_brand", "p_type", "brand#1")


@query("f11_array_match", "select p_partkey from part where list_contains(string_split(p_name, ' '), 'red') or list_has_any(string_split(p_name, ' '), ['gear', 'bolt'])")
def f11(t):
    words = F.split("p_name", " ")
    return t.part.filter(F.array_contains(words, "red") | F.arrays_overlap(words, F.array(F.lit("gear"), F.lit("bolt")))).select("p_partkey")


@query(
    "f12_satisfies_all",
    """with e as (select user_id, event_id, case event_type when 'purchase' then 0 when 'error' then 1 else 2 end as leg from events where event_type in ('purchase', 'error') or (event_type = 'view' and value > 100))
    select user_id, event_id, leg from e where user_id in (select user_id from e group by 1 having count(distinct leg) = 3)""",
)
def f12(t):
    e = F.col("event_type")
    return P.satisfies_all(t.events, "user_id", [e == "purchase", e == "error", (e == "view") & (F.col("value") > 100)]).select("user_id", "event_id", "leg")


@query("f13_redact", "select doc_id, case when toxic = 0 then quality end as quality, toxic from labels")
def f13(t):
    return t.labels.select("doc_id", *V.redact(F.col("toxic") == 1, "quality"), "toxic")
