"""Scoring and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import scoring as S
from recordloom.operators.windows import top_n

from .registry import query

HELD = "h as (select distinct l_suppkey, l_partkey % 200 as code from lineitem)"


@query(
    "x01_lookalike",
    f"""with {HELD}, g as (select distinct code from h where l_suppkey in (0, 1, 2)), w as (select code, 1 / ln(2.0 + count(*)) as w from h group by 1)
    select l_suppkey, count(*) as hits, round(sum(w), 6) as score from h join g using (code) join w using (code) where l_suppkey not in (0, 1, 2) group by 1 having count(*) >= 2""",
)
def x01(t):
    held = t.lineitem.select("l_suppkey", (F.col("l_partkey") % 200).alias("code"))
    seeds = t.supplier.filter("s_suppkey < 3").select(F.col("s_suppkey").alias("l_suppkey"))
    return S.lookalike(held, "l_suppkey", "code", F.broadcast(seeds))


@query(
    "x02_cold_start",
    """with d as (select c_custkey, c_nationkey % 5 as code from customer where c_custkey not in (select o_custkey from orders)), n as (select l_linenumber % 5 as code, l_returnflag || l_linestatus as combo, count(*) as n from lineitem group by 1, 2), p as (select combo, string_agg(l_suppkey, ',' order by k desc, l_suppkey) as partners from (select *, row_number() over (partition by combo order by k desc, l_suppkey) as r from (select l_returnflag || l_linestatus as combo, l_suppkey, count(*) as k from lineitem group by 1, 2)) where r <= 3 group by 1)
    select c_custkey, combo, score, rank, case when score >= 9 then 1 else 2 end as tier, partners from (select *, row_number() over (partition by c_custkey order by score desc, combo) as rank from (select c_custkey, combo, round(sum(ln(1 + n)), 6) as score from d join n using (code) group by 1, 2)) join p using (combo) where rank <= 3""",
)
def x02(t):
    nodes = t.lineitem.groupBy((F.col("l_linenumber") % 5).alias("code"), F.concat("l_returnflag", "l_linestatus").alias("combo")).agg(F.count(F.lit(1)).alias("n"))
    declared = t.customer.select("c_custkey", (F.col("c_nationkey") % 5).alias("code"))
    partners = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("combo"), F.col("l_suppkey").alias("partner"), F.lit(1).alias("n"))
    return S.cold_start(declared, "c_custkey", "code", nodes, t.orders.select(F.col("o_custkey").alias("c_custkey")), 3, 9.0, partners).withColumn("rank", F.col("rank").cast("long"))


@query(
    "x03_match_open",
    """with a as (select o_orderkey, o_custkey, c_nationkey from orders join customer on o_custkey = c_custkey where o_orderstatus = 'O' and o_totalprice > 450000),
    m as (select l_suppkey as s_suppkey, o_orderkey, 1 as s from a join lineitem on l_orderkey = o_orderkey union select s_suppkey, o_orderkey, 2 from a join supplier on s_nationkey = c_nationkey),
    b as (select s_suppkey, o_orderkey, min(s) as s from m group by 1, 2)
    select s_suppkey, o_orderkey, case s when 1 then 'relation' else 'place' end as edge, rank from (select *, row_number() over (partition by s_suppkey order by s, o_orderkey) as rank from b) where rank <= 5""",
)
def x03(t):
    open_awards = t.orders.filter("o_orderstatus = 'O' and o_totalprice > 450000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    relation = open_awards.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("l_suppkey").alias("s_suppkey"), "o_orderkey")
    # five places are filled by a nation's first nine awards, since at most four of them match by relation
    first = top_n(open_awards, "c_nationkey", [F.col("o_orderkey")], 2 * 5 - 1)
    place = first.join(t.supplier, F.col("s_nationkey") == F.col("c_nationkey")).select("s_suppkey", "o_orderkey")
    return S.match_open({"relation": relation, "place": place}, "s_suppkey", "o_orderkey", 5).withColumn("rank", F.col("rank").cast("long"))


@query(
    "x04_overlap",
    """with n as (select l_orderkey, list(distinct l_partkey % 10) as need from lineitem group by 1), s as (select [1, 3, 5, 7]::bigint[] as supply)
    select l_orderkey, array_to_string(list_sort(list_intersect(need, supply)), ',') as shared, round(len(list_intersect(need, supply)) / len(need), 6) as capture from n, s""",
)
def x04(t):
    need = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.col("l_partkey") % 10).alias("need"))
    shared, capture = S.overlap(F.col("need"), F.array(*[F.lit(x).cast("long") for x in (1, 3, 5, 7)]))
    return need.select("l_orderkey", F.array_join(F.transform(shared, lambda x: x.cast("string")), ",").alias("shared"), capture.alias("capture"))


@query("x05_rule_score", "select c_custkey, (c_acctbal > 5000)::int * 3 + (c_mktsegment = 'BUILDING')::int * 2 + (c_nationkey < 5)::int as score, case when (c_acctbal > 5000)::int * 3 + (c_mktsegment = 'BUILDING')::int * 2 + (c_nationkey < 5)::int >= 4 then 'A' else 'B' end as tier from customer")
def x05(t):
    score = S.rule_score([(F.col("c_acctbal") > 5000, 3), (F.col("c_mktsegment") == "BUILDING", 2), (F.col("c_nationkey") < 5, 1)])
    return t.customer.select("c_custkey", score.alias("score"), F.when(score >= 4, "A").otherwise("B").alias("tier"))


@query("x06_cohort", "select distinct c_custkey from customer where c_acctbal > 1000 and c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def x06(t):
    return S.cohort(t.customer, "c_custkey", F.col("c_acctbal") > 1000, t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")))


@query(
    "x07_slice_pack",
    """with f as (select * from orders where o_totalprice > 100000), d as (select 'o_orderstatus' as dim, o_orderstatus as value, o_totalprice from f union all select 'o_orderpriority', o_orderpriority, o_totalprice from f), g as (select dim, value, count(*) as n, sum(o_totalprice) as t, median(o_totalprice) as m from d group by 1, 2)
    select dim, value, n, round(t, 2) as total, round(t / sum(t) over (partition by dim), 6) as share, round(m, 4) as median from g""",
)
def x07(t):
    return S.slice_pack(t.orders, F.col("o_totalprice") > 100000, ["o_orderstatus", "o_orderpriority"], "o_totalprice")


@query("x08_stratified", "select doc_id, stratum, pick from (select doc_id, n_chars // 1000 as stratum, row_number() over (partition by n_chars // 1000 order by md5('11:' || doc_id), doc_id) as pick from documents) where pick <= 5")
def x08(t):
    own = S.stratified(t.documents.drop("text"), F.floor(F.col("n_chars") / 1000), "doc_id", 5, 11)
    return own.select("doc_id", "stratum", F.col("pick").cast("long").alias("pick"))


@query("x09_shard", "select o_orderkey, cast('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8) as bigint) % 16 as shard from orders")
def x09(t):
    return S.shard(t.orders, "o_orderkey", 16).select("o_orderkey", "shard")


@query(
    "x10_apply_corrections",
    """select c_custkey, case when c_custkey % 10 = 0 then 'v2' || c_custkey when c_custkey % 5 = 0 then 'v1' || c_custkey else c_name end as c_name,
    case when c_custkey % 7 <> 0 then c_mktsegment end as c_mktsegment from customer""",
)
def x10(t):
    """Names asserted once or twice; market segments asserted to be unknown."""

    def entry(field, step, seq, value):
        own = t.customer.filter(f"c_custkey % {step} = 0")
        return own.select("c_custkey", F.lit(field).alias("field"), value.alias("value"), F.lit(seq).alias("seq"))

    named = lambda seq: F.concat(F.lit(f"v{seq}"), F.col("c_custkey"))
    ledger = entry("c_name", 5, 1, named(1)).union(entry("c_name", 10, 2, named(2)))
    ledger = ledger.union(entry("c_mktsegment", 7, 1, F.lit("X"))).union(entry("c_mktsegment", 7, 2, F.lit(None).cast("string")))
    return S.apply_corrections(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey", ledger, ["c_name", "c_mktsegment"])


@query(
    "x11_book",
    """with p as (select l_suppkey, l_partkey % 100 as code, count(distinct l_orderkey) as counters, round(sum(l_extendedprice), 2) as total from lineitem group by 1, 2), r as (select *, row_number() over (partition by l_suppkey order by counters desc, code) as a, row_number() over (partition by l_suppkey order by total desc, code) as b from p), m as (select code, count(*) as market from p where total >= 50000 group by 1)
    select l_suppkey, code, counters, total, coalesce(market, 0) as market from r left join m using (code) where a <= 3 or b <= 3""",
)
def x11(t):
    return S.book(t.lineitem.withColumn("code", F.col("l_partkey") % 100), "l_suppkey", "l_orderkey", "code", "l_extendedprice", 3, 50000)


@query("x11_book_years", "select l_suppkey, year(l_shipdate) as year, l_returnflag as role, count(*) as n, count(distinct l_orderkey) as counters, round(sum(l_extendedprice), 2) as total from lineitem group by 1, 2, 3")
def x11_years(t):
    return S.book_years(t.lineitem, "l_suppkey", "l_orderkey", "l_returnflag", "l_shipdate", "l_extendedprice")
