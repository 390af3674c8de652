"""Data-quality gate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import gates as Q

from .registry import query


@query("q01_gate_counts", "with m as (select 'rows' as metric, count(*)::double as value from orders union all select 'keys', count(distinct o_custkey)::double from orders), b as (select 'rows' as metric, count(*)::double as base from orders where o_orderkey % 20 <> 0 union all select 'keys', 1.0) select metric, value, base, value >= 10 and abs(value - base) <= base * 0.1 as passed from m join b using (metric)")
def q01(t):
    metric = lambda d, keys: d.agg(F.count(F.lit(1)).cast("double").alias("rows"), keys.cast("double").alias("keys")).unpivot([], ["rows", "keys"], "metric", "value")
    now = metric(t.orders, F.count_distinct("o_custkey"))
    base = metric(t.orders.filter("o_orderkey % 20 <> 0"), F.max(F.lit(1.0)))
    return Q.gate_counts(now, base, {"rows": 10, "keys": 10}, 0.1)


@query("q02_gate_fractions", "select 'positive' as rule, round(avg((c_acctbal > 0)::int), 6) as fraction, 0.5 as least, avg((c_acctbal > 0)::int) >= 0.5 as passed from customer union all select 'named', round(avg((c_name like 'Customer%')::int), 6), 1.0, avg((c_name like 'Customer%')::int) >= 1.0 from customer")
def q02(t):
    return Q.gate_fractions(t.customer, {"positive": (F.col("c_acctbal") > 0, 0.5), "named": (F.col("c_name").startswith("Customer"), 1.0)})


@query("q03_gate_unique", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def q03(t):
    return Q.gate_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q04_gate_fusion", "select c_custkey % 500 as g, count(distinct c_nationkey) as n_ids from customer group by 1 having count(distinct c_nationkey) > 1")
def q04(t):
    return Q.gate_fusion(t.customer.withColumn("g", F.col("c_custkey") % 500), "g", "c_nationkey")


@query("q05_coverage", "with d as (select distinct l_orderkey as k from lineitem), f as (select count(*) as keys, count(o_orderkey) as found from d left join (select o_orderkey from orders where o_orderstatus <> 'P') on o_orderkey = k) select keys, found, round(found / keys, 6) as share from f")
def q05(t):
    return Q.coverage(t.lineitem.select(F.col("l_orderkey").alias("k")), t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k")), "k")


@query("q06_parity", "select 'rows' as measure, count(*)::double as a, (select count(*)::double from orders where o_orderkey % 2 = 0) as b, count(*) = (select count(*) from orders where o_orderkey % 2 = 0) as equal from orders union all select 'o_custkey', sum(o_custkey)::double, (select sum(o_custkey)::double from orders where o_orderkey % 2 = 0), sum(o_custkey) = (select sum(o_custkey) from orders where o_orderkey % 2 = 0) from orders")
def q06(t):
    return Q.parity(t.orders, t.orders.filter("o_orderkey % 2 = 0"), ["o_custkey"])


def _tagged(columns):
    """DuckDB text of a row's fields with type and length; nulls as a mark of their own."""
    return " || ".join(f"case when {c} is null then '{k}~' else '{k}:' || length({c}::varchar) || ':' || {c}::varchar end" for c, k in columns.items())


def _digest_sql(columns, source):
    part = "sum(cast('0x' || substr(h, {}, 8) as hugeint)) % 2305843009213693951"
    return f"select count(*) as n, concat_ws('-', {', '.join(part.format(1 + 8 * i) for i in range(4))}) as digest from (select sha256({_tagged(columns)}) as h from {source})"


Q07 = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"}


@query("q07_digest", _digest_sql(Q07, "(select c_custkey, c_name, c_nationkey, case when c_custkey % 9 <> 0 then c_mktsegment end as c_mktsegment from customer)"))
def q07(t):
    segment = F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    return Q.digest(t.customer.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("int"), segment))


@query(
    "q08_gate_schema",
    """select * from (values ('c_custkey', 'bigint', 'string', false), ('c_name', 'string', 'string', true), ('c_nationkey', 'int', null, false), ('c_phone', null, 'string', false)) x("column", a, b, same)
    where exists (select 1 from customer)""",
)
def q08(t):
    """A table against an altered copy: one type changed, one column gone, one new."""
    own = t.customer.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("int"))
    return Q.gate_schema(t.spark, own, own.select(F.col("c_custkey").cast("string"), "c_name", F.lit("").alias("c_phone")))


@query("q09_gate_plans", "select * from (values ('equi', '', true), ('theta', 'CartesianProduct', false)) x(plan, joins, passed) where exists (select 1 from orders)")
def q09(t):
    """An equi-join passes; all pairs of two tables do not."""
    orders, customers = t.orders.select("o_custkey"), t.customer.select("c_custkey")
    pairs = orders.hint("shuffle_replicate_nl").crossJoin(customers)
    return Q.gate_plans(t.spark, {"equi": orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), "theta": pairs})


PROFILE = "select '{c}' as column, count(*) as n, count(*) filter (where {c} is null) as nulls, count(distinct {c}) as n_distinct, min({c}::varchar) as least, max({c}::varchar) as most, {q} as quartiles, (select string_agg(v || ':' || k, ',' order by k desc, v) from (select {c}::varchar as v, count(*) as k from customer group by 1 order by 2 desc, 1 limit 3)) as top, round(count(*) filter (where {c} is null) / count(*), 6) as null_rate from customer"


@query("q10_profile", f"{PROFILE.format(c='c_mktsegment', q='null')} union all {PROFILE.format(c='c_nationkey', q="concat_ws(',', quantile_disc(c_nationkey::double, 0.25), quantile_disc(c_nationkey::double, 0.5), quantile_disc(c_nationkey::double, 0.75))")}")
def q10(t):
    return Q.profile(t.customer, ["c_mktsegment", "c_nationkey"]).withColumn("quartiles", F.array_join(F.transform("quartiles", lambda x: x.cast("string")), ","))


COLUMNS = {"customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "labels": ["doc_id", "quality", "toxic"], "documents": ["doc_id", "text", "lang", "source", "n_chars"]}


@query("q13_fill_catalog", " union all ".join(f"select '{t}' as dataset, {i} as position, '{c}' as column, count(*) as n, count({c}) as present from {t}" for t, cs in COLUMNS.items() for i, c in enumerate(cs)))
def q13(t):
    return Q.fill_catalog(t.spark, {n: getattr(t, n) for n in COLUMNS}).drop("type")


LEDGER = "l as (select event_type as feed, ts as run_at, case when value > 300 then 'failed' else 'ok' end as status, event_id from events)"


@query("q11_stale_feeds", f"with {LEDGER}, g as (select feed, arg_max(status, run_at) as last_status, max(run_at) filter (where status = 'ok') as last_ok from l group by 1) select feed, last_status, date_diff('day', cast(last_ok as date), date '2024-02-03') as age_days from g where last_status <> 'ok' or last_ok is null or date_diff('day', cast(last_ok as date), date '2024-02-03') > 3")
def q11(t):
    ledger = t.events.select(F.col("event_type").alias("feed"), F.col("ts").alias("run_at"), F.when(F.col("value") > 300, "failed").otherwise("ok").alias("status"))
    return Q.stale_feeds(ledger, "2024-02-03", 3).select("feed", "last_status", F.col("age_days").cast("long").alias("age_days"))


@query("q12_reconcile", "select coalesce(a.k, b.k) as k, case when b.k is null then 'missing' when a.k is null then 'orphan' else 'matched' end as state from (select distinct o_orderkey as k from orders where o_orderkey % 3 <> 0) a full join (select distinct l_orderkey as k from lineitem) b on a.k = b.k")
def q12(t):
    return Q.reconcile(t.orders.filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k")), "k")
