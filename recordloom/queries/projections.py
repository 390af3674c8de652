"""Projection, typing and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import values as V
from recordloom.operators import project as P

from .registry import query


@query("p01_blank_null", "select doc_id, nullif(trim(case when doc_id % 4 = 0 then '  ' else ' ' || source || ' ' end), '') as source from documents")
def p01(t):
    from recordloom.functions.keys import blank_null

    raw = F.when(F.col("doc_id") % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("source"), F.lit(" ")))
    return t.documents.select("doc_id", blank_null(raw).alias("source"))


@query("p02_try_cast", "select event_id, try_cast(case when event_id % 3 = 0 then event_type else cast(event_id as varchar) end as bigint) as n from events")
def p02(t):
    return t.events.select("event_id", V.try_cast(F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string")), "bigint").alias("n"))


@query("p03_parse_date", "select o_orderkey, case when o_orderkey % 4 <> 3 then cast(o_orderdate as date) end as day from orders")
def p03(t):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MM/dd/yyyy")).when(k == 2, F.date_format(d, "yyyyMMdd")).otherwise("unknown")
    return t.orders.select("o_orderkey", V.parse_date(text, ["yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd"]).alias("day"))


@query("p04_parse_money", "select o_orderkey, cast(case when o_orderkey % 2 = 0 then cast(o_orderkey as bigint) * 1000 + 0.25 else -(cast(o_orderkey as bigint) * 1000 + 0.25) end as double) as amount from orders")
def p04(t):
    text = F.concat(F.lit("$"), F.format_string("%,d", F.col("o_orderkey") * 1000), F.lit(".25"))
    return t.orders.select("o_orderkey", V.parse_money(F.when(F.col("o_orderkey") % 2 == 0, text).otherwise(F.concat(F.lit("("), text, F.lit(")")))).cast("double").alias("amount"))


@query("p05_clamp", "select o_orderkey, case when o_totalprice between 1000 and 300000 then o_totalprice end as price, case when cast(o_orderdate as date) between date '1996-01-01' and date '2000-12-31' then cast(o_orderdate as date) end as day from orders")
def p05(t):
    return t.orders.select("o_orderkey", V.clamp(F.col("o_totalprice"), 1000, 300000).alias("price"), V.clamp(F.col("o_orderdate").cast("date"), F.to_date(F.lit("1996-01-01")), F.to_date(F.lit("2000-12-31"))).alias("day"))


SPEC = [
    ("id", "bigint", {"customer": "c_custkey", "supplier": "s_suppkey"}),
    ("name", "string", {"customer": "c_name", "supplier": "s_name"}),
    ("nation", "int", {"customer": "c_nationkey", "supplier": "s_nationkey"}),
    ("segment", "string", {"customer": "c_mktsegment"}),
]


@query("p06_project", "select c_custkey as id, c_name as name, c_nationkey as nation, c_mktsegment as segment from customer union all select s_suppkey, s_name, s_nationkey, null from supplier")
def p06(t):
    return P.project(t.customer, SPEC, "customer").unionByName(P.project(t.supplier, SPEC, "supplier"))


@query("p07_select_star", "select o_orderkey, upper(o_orderstatus) || '!' as o_orderstatus, o_custkey as customer from orders")
def p07(t):
    return P.select_star(t.orders, ["o_totalprice", "o_orderdate", "o_orderpriority"], {"o_orderstatus": F.concat(F.upper("o_orderstatus"), F.lit("!"))}, {"o_custkey": "customer"})


@query("p08_classify", "select p_partkey, case when p_type in ('ECONOMY', 'SMALL') then 'low' when p_type in ('PROMO', 'STANDARD') then 'mid' else 'other' end as class from part")
def p08(t):
    return t.part.select("p_partkey", V.classify(F.col("p_type"), {"low": ["ECONOMY", "SMALL"], "mid": ["PROMO", "STANDARD"]}, "other").alias("class"))


@query("p09_decode", "select o_orderkey, case o_orderstatus when 'F' then 'filled' when 'O' then 'open' end as status_name from orders")
def p09(t):
    vocab = t.spark.createDataFrame([("F", "filled"), ("O", "open")], "code string, status_name string")
    return P.decode(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", F.broadcast(vocab), "code", "status_name").select("o_orderkey", "status_name")


@query(
    "p10_unpivot_blocks",
    """with w as (select o_custkey, min(o_totalprice) as a, case when o_custkey % 3 <> 0 then max(o_totalprice) end as b from orders group by 1)
    select o_custkey, 1 as slot, a as amount, 'min' as kind from w union all select o_custkey, 2, b, 'max' from w where b is not null""",
)
def p10(t):
    w = t.orders.groupBy("o_custkey").agg(F.min("o_totalprice").alias("a"), F.when(F.col("o_custkey") % 3 != 0, F.max("o_totalprice")).alias("b")).withColumns({"ka": F.lit("min"), "kb": F.when(F.col("b").isNotNull(), "max")})
    return P.unpivot_blocks(w, ["o_custkey"], [{"amount": "a", "kind": "ka"}, {"amount": "b", "kind": "kb"}])


@query("p11_explode_fields", "select o_orderkey, 'status' as field, o_orderstatus as code from orders union all select o_orderkey, 'priority', substr(o_orderpriority, 1, 1) from orders")
def p11(t):
    return P.explode_fields(t.orders, ["o_orderkey"], {"status": F.col("o_orderstatus"), "priority": F.substring("o_orderpriority", 1, 1)})


@query("p12_parse_list", "select p_partkey, upper(replace(p_name, ' ', '+')) as words, len(string_split(p_name, ' ')) as n from part")
def p12(t):
    words = V.parse_list(F.regexp_replace(F.upper("p_name"), " ", "~ ;;"), ";", "~$")
    return t.part.select("p_partkey", F.array_join(words, "+").alias("words"), F.size(words).cast("long").alias("n"))


@query("p13_surrogate", "select o_orderkey, md5(o_orderkey || '|' || o_custkey || '|' || o_orderstatus) as id, sha256(o_orderkey || '|' || o_custkey) as long_id from orders")
def p13(t):
    return t.orders.select("o_orderkey", V.surrogate(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), bits=128).alias("id"), V.surrogate(F.col("o_orderkey"), F.col("o_custkey")).alias("long_id"))


@query("p14_concat_key", "select o_orderkey, o_orderstatus || '-' || o_custkey || '-' || (case when o_orderkey % 5 <> 0 then o_orderkey end) as natural_key from orders")
def p14(t):
    return t.orders.select("o_orderkey", V.concat_key(F.col("o_orderstatus"), F.col("o_custkey"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey"))).alias("natural_key"))


@query("p15_first_present", "select c_custkey, case when c_custkey % 2 = 0 then c_name when c_custkey % 3 = 0 then c_mktsegment end as value, case when c_custkey % 2 = 0 then 'name' when c_custkey % 3 = 0 then 'segment' end as source from customer")
def p15(t):
    k = F.col("c_custkey")
    return t.customer.select("c_custkey", V.first_present(name=F.when(k % 2 == 0, F.col("c_name")), segment=F.when(k % 3 == 0, F.col("c_mktsegment"))).alias("f")).select("c_custkey", "f.*")


@query("p16_fiscal_year", "select cast(year(cast(o_orderdate as date) + interval 3 month) as bigint) as fy, count(*) as n, max(cast(o_orderdate as date)) as last_day from orders group by 1")
def p16(t):
    return t.orders.groupBy(V.fiscal_year(F.col("o_orderdate")).cast("long").alias("fy")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("o_orderdate").cast("date")).alias("last_day"))


@query("p17_json_get", "select event_id, cast(json_extract(props, '$.k') as bigint) as k, cast(null as varchar) as missing from events")
def p17(t):
    return t.events.select("event_id", V.json_get(F.col("props"), "$.k", "bigint").alias("k"), V.json_get(F.col("props"), "$.z").alias("missing"))


@query("o01_top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 20")
def o01(t):
    return t.orders.orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("o02_page", "select o_orderkey from orders order by o_orderdate, o_orderkey limit 50 offset 100")
def o02(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").offset(100).limit(50).select("o_orderkey")


@query("o03_union_tagged", "select c_custkey as id, c_mktsegment as segment, null as balance, 'customer' as source from customer union all select s_suppkey, null, s_acctbal, 'supplier' from supplier")
def o03(t):
    return P.union_tagged({"customer": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), "supplier": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))})


@query("o04_key_universe", "select c_custkey as k from customer union select o_custkey from orders union select l_suppkey from lineitem")
def o04(t):
    return P.key_universe(t.customer.select(F.col("c_custkey").alias("k")), t.orders.select("o_custkey"), t.lineitem.select("l_suppkey"))


@query("o05_intersect", "select o_custkey from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_totalprice > 400000")
def o05(t):
    return t.orders.filter("o_orderstatus = 'F'").select("o_custkey").intersect(t.orders.filter("o_totalprice > 400000").select("o_custkey"))


@query("o06_subtract", "select c_custkey from customer except select o_custkey from orders where o_totalprice > 400000")
def o06(t):
    return t.customer.select("c_custkey").subtract(t.orders.filter("o_totalprice > 400000").select("o_custkey"))


@query("o07_distinct", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def o07(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "o08_set_delta",
    """with s as (select user_id, event_type, bool_or(ts < timestamp '2024-01-03') as old, bool_or(ts >= timestamp '2024-01-28') as new from events group by 1, 2)
    select user_id, case when new then 'added' else 'removed' end as change, event_type as member from s where old <> new""",
)
def o08(t):
    side = lambda c: F.collect_set(F.when(c, F.col("event_type")))
    sets = t.events.groupBy("user_id").agg(side(F.col("ts") < "2024-01-03").alias("old"), side(F.col("ts") >= "2024-01-28").alias("new"))
    return P.set_delta(sets, "user_id", "old", "new")
