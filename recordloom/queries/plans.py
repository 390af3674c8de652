"""Composite job queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions.keys import legal_name_base, name_norm, person_key
from recordloom.operators.aggregates import nest
from recordloom.plans import profiles as P
from recordloom.plans import reconcile as R

from .registry import query

FEED_SPEC = [("k", "bigint", {"fresh": "o_orderkey", "bulk": "o_orderkey"}), ("price", "double", {"fresh": "o_totalprice * 2", "bulk": "o_totalprice"}), ("modified", "date", {"fresh": "date_add(cast(o_orderdate as date), 1)", "bulk": "cast(o_orderdate as date)"}), ("priority", "string", {"bulk": "o_orderpriority"})]
FRESH, BULK = "select o_orderkey as k, o_totalprice * 2 as price, cast(o_orderdate as date) + 1 as modified, cast(null as varchar) as priority from orders where o_orderkey % 2 = 0", "select o_orderkey as k, o_totalprice as price, cast(o_orderdate as date) as modified, o_orderpriority as priority from orders where o_orderkey % 3 <> 0"


@query("r01_canonicalise", f"with f as ({FRESH}), b as ({BULK}), u as (select *, 'fresh' as source, 0 as r from f union all select *, 'bulk', 1 from b) select k, price, modified, priority, source, n_sources from (select *, count(*) over (partition by k) as n_sources, row_number() over (partition by k order by modified desc nulls last, r) as rn from u) where rn = 1")
def r01(t):
    feeds = {"fresh": t.orders.filter("o_orderkey % 2 = 0"), "bulk": t.orders.filter("o_orderkey % 3 <> 0")}
    return R.canonicalise(feeds, FEED_SPEC, "k", "modified", ["price"])


@query("r02_merge_delta", f"with b as (select case when k % 50 <> 1 then k end as k, price, modified from ({BULK})), d as (select k, price, modified - (k % 4)::integer as modified from ({FRESH})), u as (select *, 'delta' as source from d union all select *, 'bulk' from b) select k, price, modified, source from (select *, row_number() over (partition by k order by modified desc, source desc, price) as rn from u where k is not null) where rn = 1 union all select k, price, modified, source from u where k is null")
def r02(t):
    day = F.col("o_orderdate").cast("date")
    bulk = t.orders.filter("o_orderkey % 3 <> 0").select(F.when(F.col("o_orderkey") % 50 != 1, F.col("o_orderkey")).alias("k"), F.col("o_totalprice").alias("price"), day.alias("modified"))
    delta = t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") * 2).alias("price"), F.date_sub(F.date_add(day, 1), (F.col("o_orderkey") % 4).cast("int")).alias("modified"))
    return R.merge_delta(bulk, delta, "k", "modified", "price")


@query("r03_award_state", "with s as (select l_orderkey, round(sum(l_extendedprice), 2) as obligated, count(*) as n_actions, max(cast(l_shipdate as date)) as end_day from lineitem group by 1) select l_orderkey, obligated, n_actions, end_day, o_totalprice as ceiling, round(obligated / nullif(o_totalprice, 0), 6) as consumed, round(o_totalprice - obligated, 2) as headroom, date_diff('day', date '1998-08-02', end_day) as days_left, end_day >= date '1998-08-02' as is_active from s left join orders on o_orderkey = l_orderkey")
def r03(t):
    ceiling = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("ceiling"))
    return R.award_state(t.lineitem, "l_orderkey", ["l_shipdate", "l_linenumber"], "l_extendedprice", "l_shipdate", ceiling, "1998-08-02").withColumn("days_left", F.col("days_left").cast("long"))


@query("r04_mod_delta", "with d as (select event_id, round(value - lag(value) over w, 2) as d_value, case when lag(event_id) over w is not null then concat_ws(',', case when event_type is distinct from lag(event_type) over w then 'event_type' end) end as changed from events window w as (partition by user_id order by ts, event_id)) select event_id, d_value, changed, case when d_value is null then 'first' when d_value > 0 then 'increase' when d_value < 0 then 'decrease' when changed <> '' then 'change' else 'none' end as action_class from d")
def r04(t):
    return R.mod_delta(t.events, "user_id", ["ts", "event_id"], "value", ["event_type"]).select("event_id", "d_value", "changed", "action_class")


@query(
    "r05_entity_versions",
    """with a as (select *, lag(o_orderstatus) over w as b, lead(o_orderstatus) over w as n from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)), v as (select *, case when b is not null and b is not distinct from n then b else o_orderstatus end as v from a),
    i as (select *, cast(sum(case when v is distinct from pv then 1 else 0 end) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) as bigint) as version from (select *, lag(v) over (partition by o_custkey order by o_orderdate, o_orderkey) as pv from v)),
    g as (select o_custkey, version, count(*) as n_rows, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) filter (where o_orderstatus = v) as o_orderstatus from i group by 1, 2)
    select o_custkey, version, n_rows, o_orderstatus, md5(concat_ws('|', o_custkey, version, o_orderstatus)) as version_key from g""",
)
def r05(t):
    return R.entity_versions(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus"], "o_orderdate").select("o_custkey", "version", "n_rows", "o_orderstatus", "version_key")


SNAPS = "d as (select user_id, cast(ts as date) as day, arg_max(event_type, (ts, event_id)) as last_type, list(distinct event_type) as types from events group by 1, 2), l as (select day, dense_rank() over (order by day) as r from (select distinct day from d)), n as (select d.*, r from d join l using (day)), p as (select a.user_id, a.day, a.last_type, a.types, b.last_type as old_last, b.types as old_types from n a join n b on a.user_id = b.user_id and a.r = b.r + 1)"


def _snaps(t):
    return t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.collect_set("event_type").alias("types"))


@query(
    "r06_profile_deltas",
    f"""with {SNAPS} select user_id, day, 'last_type' as field, 'changed' as change, old_last as old, last_type as new from p where old_last <> last_type
    union all select user_id, day, 'types', 'added', null, m from (select user_id, day, unnest(list_filter(types, lambda x: not list_contains(old_types, x))) as m from p)
    union all select user_id, day, 'types', 'removed', m, null from (select user_id, day, unnest(list_filter(old_types, lambda x: not list_contains(types, x))) as m from p)""",
)
def r06(t):
    return R.profile_deltas(_snaps(t), "user_id", "day", ["last_type"], ["types"])


@query(
    "r07_signal_events",
    """with e as (select *, cast(ts as date) as day, cast(value / 100 as bigint) as code from events), f as (select user_id, min(day) as day from e group by 1), c as (select user_id, code, min(day) as day from e group by 1, 2), r as (select user_id, day, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as p from e)
    select user_id, day, 'first_seen' as signal, null as value from f union select c.user_id, c.day, 'code_added', cast(code as varchar) from c join f using (user_id) where c.day > f.day union select user_id, day, 'role_changed', p || '>' || event_type from r where p <> event_type""",
)
def r07(t):
    own = t.events.withColumn("code", F.rint(F.col("value") / 100).cast("long"))  # a half to the even number, as SQL casts it
    return R.signal_events(own, "user_id", F.col("ts").cast("date"), ["ts", "event_id"], "code", "event_type")


@query("r08_entity_master", f"with {SNAPS} select user_id, arg_max(last_type, day) as last_type, min(day) as first_seen, max(day) as last_seen, count(distinct day) as n_seen, bool_or(last_type <> 'view') as ever_inactive, arg_max(last_type = 'view', day) as active_last from d group by 1")
def r08(t):
    return R.entity_master(_snaps(t), "user_id", "day", F.col("last_type") == "view", ["last_type"])


@query("r08_entity_satellites", f"with {SNAPS}, z as (select user_id, arg_max(types, day) as types from d group by 1) select user_id, cast(i - 1 as integer) as position, types[i] as value from (select user_id, list_sort(types) as types, unnest(range(1, len(types) + 1)) as i from z)")
def r08_satellites(t):
    listed = _snaps(t).withColumn("types", F.array_join(F.array_sort("types"), " ; "))
    return R.satellites(R.entity_master(listed, "user_id", "day", F.col("last_type") == "view", ["types"], {"types": ";"}), "user_id", "types")


@query("r09_gold_profile", "select c_custkey, c_name, coalesce(n_orders, 0) as n_orders, coalesce(total, 0) as total, orders from customer left join (select o_custkey, count(*) as n_orders, round(sum(o_totalprice), 2) as total from orders group by 1) m on m.o_custkey = c_custkey left join (select o_custkey, string_agg(o_orderkey, ',' order by o_orderdate, o_orderkey) as orders from orders where o_orderstatus = 'O' group by 1) n on n.o_custkey = c_custkey")
def r09(t):
    own = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    contacts = nest(own.filter("o_orderstatus = 'O'"), "c_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"], "orders")
    money = own.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    gold = P.gold_profile(t.customer.select("c_custkey", "c_name"), "c_custkey", contacts, money)
    return gold.withColumn("orders", F.array_join(F.transform("orders", lambda r: r["o_orderkey"].cast("string")), ","))


SIDE = "select k, round(sum(v), 2) as total, sum(c)::bigint as n, coalesce(string_agg(case when rn <= 3 then p end, ',' order by rn), '') as top from (select k, p, v, c, row_number() over (partition by k order by v desc, p) as rn from (select {k} as k, {p} as p, sum(l_extendedprice) as v, count(*) as c from lineitem where {w} group by 1, 2)) group by 1"


@query(
    "r10_entity_summary",
    f"with a as ({SIDE.format(k='l_suppkey', p='l_partkey', w='l_linenumber <= 4')}), s as ({SIDE.format(k='l_partkey % 120', p='l_suppkey', w='l_linenumber > 4')}) select coalesce(a.k, s.k) as k, coalesce(a.total, 0) as award_total, coalesce(a.n, 0) as award_n, coalesce(a.top, '') as award_top, coalesce(s.total, 0) as sub_total, coalesce(s.n, 0) as sub_n, coalesce(s.top, '') as sub_top from a full join s on a.k = s.k",
)
def r10(t):
    awards = t.lineitem.filter("l_linenumber <= 4").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("p"), "l_extendedprice")
    subs = t.lineitem.filter("l_linenumber > 4").select((F.col("l_partkey") % 120).alias("k"), F.col("l_suppkey").alias("p"), "l_extendedprice")
    return P.entity_summary(awards, subs, "k", "l_extendedprice", "p")


EVIDENCE = "e as (select c_nationkey as org, 'person ' || chr(cast(97 + c_custkey % 26 as integer)) || 'x' as name, case when c_custkey % 2 = 0 then c_mktsegment end as title, 2 as priority, 'customer' as source from customer union all select s_nationkey, chr(cast(97 + s_suppkey % 26 as integer)) || 'x PERSON', 'OWNER', 1, 'supplier' from supplier)"


@query("r11_people", f"with {EVIDENCE}, k as (select *, array_to_string(list_sort(string_split(lower(name), ' ')), ' ') as name_key from e) select md5(org || '|' || name_key) as person_id, org, name_key, arg_min(title, (priority, title)) filter (where title is not null) as title, string_agg(distinct source, '+' order by source) as sources, count(*) as mentions from k group by org, name_key")
def r11(t):
    letter = lambda c: F.concat(F.chr((97 + F.col(c) % 26).cast("long")), F.lit("x"))
    a = t.customer.select(F.col("c_nationkey").alias("org"), F.concat(F.lit("person "), letter("c_custkey")).alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("title"), F.lit(2).alias("priority"), F.lit("customer").alias("source"))
    b = t.supplier.select(F.col("s_nationkey").alias("org"), F.concat(letter("s_suppkey"), F.lit(" PERSON")).alias("name"), F.lit("OWNER").alias("title"), F.lit(1).alias("priority"), F.lit("supplier").alias("source"))
    return P.people(a.union(b).withColumn("name_key", person_key(F.col("name"))), "org", "name_key", "title", "priority")


@query("r12_normalise_registries", "with u as (select c_custkey as id, upper(replace(c_name, '#', '')) as name, c_mktsegment as kind, 'customer' as source from customer union all select s_suppkey, upper(replace(s_name, '#', '')), null, 'supplier' from supplier) select id, name || ' LLC' as name, kind, source, name || ' LLC' as name_key, name as name_base, md5(source || '|' || id) as registry_key from u")
def r12(t):
    spec = [("id", "bigint", {"customer": "c_custkey", "supplier": "s_suppkey"}), ("name", "string", {"customer": "upper(replace(c_name, '#', '')) || ' LLC'", "supplier": "upper(replace(s_name, '#', '')) || ' LLC'"}), ("kind", "string", {"customer": "c_mktsegment"})]
    return R.normalise_registries({"customer": t.customer, "supplier": t.supplier}, spec, "name", name_norm, legal_name_base)


@query("r13_satellites", "with w as (select o_custkey, cast(min(o_orderkey) as varchar) as a, case when o_custkey % 3 <> 0 then cast(max(o_orderkey) as varchar) end as b, min(o_orderpriority) as c from orders group by 1) select o_custkey, 'order' as family, 1 as slot, a as value from w union all select o_custkey, 'order', 2, b from w where b is not null union all select o_custkey, 'priority', 1, c from w")
def r13(t):
    w = t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("a"), F.when(F.col("o_custkey") % 3 != 0, F.max("o_orderkey")).alias("b"), F.min("o_orderpriority").alias("c"))
    return P.satellites(w, "o_custkey", {"order": ["a", "b"], "priority": ["c"]})


@query(
    "r14_profile_360",
    """with p as (select l_suppkey, year(l_shipdate) as y, sum(l_quantity) as v from lineitem group by 1, 2), b as (select l_suppkey, max(y) as latest_year, round(arg_max(v, y), 2) as latest, arg_max(v, y) as raw, round(sum(v), 2) as lifetime, count(*) as active_years from p group by 1)
    select b.l_suppkey, latest_year, latest, lifetime, active_years, round(raw / nullif(p.v, 0) - 1, 6) as yoy, coalesce(raw / nullif(p.v, 0) - 1 > 0, false) as is_growing from b left join p on p.l_suppkey = b.l_suppkey and p.y = latest_year - 1""",
)
def r14(t):
    own = t.lineitem.withColumn("y", F.year("l_shipdate").cast("long"))
    return P.profile_360(own, "l_suppkey", "y", "l_quantity").drop("by_year")


@query("r15_facility_360", "select s_suppkey, s_name, coalesce(a.n, 0) as n_lines, coalesce(b.n, 0) as n_returns, (coalesce(a.n, 0) > 0)::int + (coalesce(b.n, 0) > 0)::int as n_programs from supplier left join (select l_suppkey, count(*) as n from lineitem group by 1) a on a.l_suppkey = s_suppkey left join (select l_suppkey, count(*) as n from lineitem where l_returnflag = 'R' and l_suppkey % 2 = 0 group by 1) b on b.l_suppkey = s_suppkey")
def r15(t):
    lines = t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey")
    return P.facility_360(t.supplier.select("s_suppkey", "s_name"), "s_suppkey", {"lines": lines, "returns": lines.filter("l_returnflag = 'R' and s_suppkey % 2 = 0")})


@query("r16_award_book", "select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as total, round(median(o_totalprice), 4) as median, count(distinct o_orderpriority) as kinds from orders group by 1")
def r16(t):
    return P.award_book(t.orders, "o_custkey", "o_totalprice", "o_orderpriority")


@query("r16_pricing_flow", "with d as (select *, cast(o_orderdate as date) as day from orders) select o_custkey, o_orderpriority, round(sum(case when day > date '1997-08-02' then o_totalprice else 0 end), 2) as recent, round(sum(case when day <= date '1997-08-02' then o_totalprice else 0 end), 2) as prior from d where day > date '1996-08-02' and day <= date '1998-08-02' group by 1, 2")
def r16_flow(t):
    return P.pricing_flow(t.orders, "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "1998-08-02")


@query("r17_align_rates", 'with m as (select s_nationkey as area, l_returnflag as f, round(median(l_extendedprice / l_quantity), 4) as r from lineitem join supplier on s_suppkey = l_suppkey group by 1, 2), w as (select area, max(r) filter (where f = \'A\') as "A", max(r) filter (where f = \'N\') as "N", max(r) filter (where f = \'R\') as "R" from m group by 1) select area, "A" as rate_a, "N" as rate_n, "R" as rate_r, round(greatest("A", "N", "R") - least("A", "N", "R"), 4) as spread from w')
def r17(t):
    rates = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("area"), "l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("rate"))
    return P.align_rates(rates, "area", "l_returnflag", "rate", ["A", "N", "R"]).withColumnsRenamed({"A": "rate_a", "N": "rate_n", "R": "rate_r"})


@query("r18_combo_dim", "with p as (select p_brand, p_type, p_size % 4 as category, round(avg(p_retailprice), 4) as price, count(*) as n from part group by 1, 2, 3) select p_brand, p_type, string_agg(category || ':' || n, ',' order by category) as categories from p group by 1, 2")
def r18(t):
    dim = P.combo_dim(t.part.withColumn("category", F.col("p_size") % 4), ["p_brand", "p_type"], "category", "p_retailprice")
    return dim.select("p_brand", "p_type", F.array_join(F.transform("categories", lambda r: F.concat_ws(":", r["category"].cast("string"), r["n"].cast("string"))), ",").alias("categories"))


@query("r19_rates_for", "select l_orderkey, l_partkey, l_extendedprice, o_custkey from lineitem join orders on o_orderkey = l_orderkey where o_custkey % 40 = 7")
def r19(t):
    nested = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_extendedprice")).alias("items"))
    spine = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return P.rates_for(nested, spine, spine.filter("o_custkey % 40 = 7"), "l_orderkey")


@query("r20_corroborate", "select doc_id, phrase, instr(lower(text), phrase) as at from documents, (values ('clown'), ('the'), ('und')) v(phrase) where instr(lower(text), phrase) > 0")
def r20(t):
    items = t.documents.select("doc_id", F.explode(F.array(F.lit("clown"), F.lit("the"), F.lit("und"))).alias("phrase"))
    return P.corroborate(items, t.documents, "doc_id", "phrase", "text").withColumn("at", F.col("at").cast("long"))


@query("r21_partner_signals", "with e as (select o_custkey as parent, l_suppkey as partner, max(cast(l_shipdate as date)) as last_active from orders join lineitem on o_orderkey = l_orderkey group by 1, 2), v as (select o_custkey as parent, cast(o_orderdate as date) as day, o_orderstatus from orders where cast(o_orderdate as date) >= date '2001-01-01') select partner, count(*) as n_events, max(day) as last_event, max(day) filter (where o_orderstatus = 'F') as last_of_class, bool_or(day > last_active) as after_last_activity from e join v using (parent) group by 1")
def r21(t):
    edges = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("parent"), F.col("l_suppkey").alias("partner")).agg(F.max(F.col("l_shipdate").cast("date")).alias("last_active"))
    events = t.orders.select(F.col("o_custkey").alias("parent"), F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    return P.partner_signals(edges, events, "parent", "partner", "2001-01-01", F.col("o_orderstatus") == "F")


@query("r22_assemble", "select o_orderkey, o_custkey, c_name, string_agg(l_partkey, ',' order by l_linenumber, l_partkey, l_suppkey, l_shipdate) as parts from orders join customer on c_custkey = o_custkey left join lineitem on l_orderkey = o_orderkey group by 1, 2, 3")
def r22(t):
    spine = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    out = P.assemble(spine, "o_orderkey", {"parts": (lines, ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], ["l_partkey"])})
    return out.select("o_orderkey", "o_custkey", "c_name", F.array_join(F.transform("parts", lambda r: r["l_partkey"].cast("string")), ",").alias("parts"))
