"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import joins as J

from .registry import query

LAT_C, LON_C = "cast(25 + ((c_custkey * 7919) % 2500) / 100.0 as double)", "cast(-124 + ((c_custkey * 104729) % 5700) / 100.0 as double)"
LAT_S, LON_S = LAT_C.replace("c_custkey", "(s_suppkey + 50000)"), LON_C.replace("c_custkey", "(s_suppkey + 50000)")
MILES = "2 * 3958.7613 * asin(sqrt(least(pow(sin(radians(blat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(blat)) * pow(sin(radians(blon - lon) / 2), 2), 1.0)))"
CUSTOMERS = f"select c_custkey, {LAT_C} as lat, {LON_C} as lon from customer"
SITES = f"select s_suppkey, {LAT_S} as blat, {LON_S} as blon from supplier"


def places(t):
    return t.customer.select("c_custkey", F.expr(LAT_C).alias("lat"), F.expr(LON_C).alias("lon"))


def sites(t):
    return t.supplier.select("s_suppkey", F.expr(LAT_S).alias("blat"), F.expr(LON_S).alias("blon"))


@query("j01_inner_join", "select o_orderkey, o_custkey, count(*) as lines, round(sum(l_quantity), 2) as quantity from orders join lineitem on o_orderkey = l_orderkey group by 1, 2")
def j01(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return t.orders.select("o_orderkey", "o_custkey").join(lines, "o_orderkey")


@query("j02_left_join_1", "select o_orderkey, c_name from orders left join customer on o_custkey = c_custkey and c_custkey % 2 = 0")
def j02(t):
    dim = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return J.left_join_1(t.orders.select("o_orderkey", "o_custkey"), dim, ["o_custkey"]).select("o_orderkey", "c_name")


@query(
    "j03_outer_resolve",
    """with a as (select o_orderkey, o_totalprice as price, cast(o_orderdate as date) as modified from orders where o_orderkey % 3 <> 0),
    b as (select o_orderkey, o_totalprice * 2 as price, cast(o_orderdate as date) + (case when o_orderkey % 4 = 0 then 1 else -1 end)::integer as modified from orders where o_orderkey % 2 = 0)
    select o_orderkey, case when b.price is null or (a.price is not null and a.modified >= b.modified) then 'a' else 'b' end as side,
      case when b.price is null or (a.price is not null and a.modified >= b.modified) then a.price else b.price end as price from a full join b using (o_orderkey)""",
)
def j03(t):
    day = F.col("o_orderdate").cast("date")
    a = t.orders.filter("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_totalprice").alias("price"), day.alias("modified"))
    b = t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("price"), F.date_add(day, F.when(F.col("o_orderkey") % 4 == 0, 1).otherwise(-1)).alias("modified"))
    return J.outer_resolve(a, b, "o_orderkey", "modified").select("o_orderkey", "side", "price")


@query("j04_dimension_join", "select c_custkey, n_name, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def j04(t):
    dim = t.nation.join(J.small(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(J.small(dim), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query("j05_semi_join", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)")
def j05(t):
    return t.customer.join(t.orders.filter("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("j06_anti_join", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def j06(t):
    return t.customer.join(t.orders.filter("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j07_values_join", "select p_partkey from part where (p_brand, p_size) in (('Brand#2', 11), ('Brand#17', 28), ('Brand#3', 5))")
def j07(t):
    return J.values_join(t.part, ["p_brand", "p_size"], [("Brand#2", 11), ("Brand#17", 28), ("Brand#3", 5)]).select("p_partkey")


@query("j08_with_params", "select o_orderkey, date_diff('day', cast(o_orderdate as date), (select max(cast(o_orderdate as date)) from orders)) as age from orders")
def j08(t):
    anchor = t.orders.agg(F.max(F.col("o_orderdate").cast("date")).alias("last_day"))
    return J.with_params(t.orders.select("o_orderkey", "o_orderdate"), anchor).select("o_orderkey", F.datediff("last_day", F.col("o_orderdate").cast("date")).cast("long").alias("age"))


BASKETS = "select distinct l_orderkey, l_partkey % 50 as item from lineitem"


@query("j09_pairs", f"with b as ({BASKETS}) select x.item as item_a, y.item as item_b, count(*) as n from b x join b y using (l_orderkey) where x.item < y.item group by 1, 2")
def j09(t):
    own = t.lineitem.select("l_orderkey", (F.col("l_partkey") % 50).alias("item"))
    return J.pairs(own, "l_orderkey", "item").groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))


PARTS = "select distinct l_orderkey, l_partkey as item from lineitem"


@query("j09_pairs_parts", f"with b as ({PARTS}) select x.item as item_a, y.item as item_b, count(*) as n from b x join b y using (l_orderkey) where x.item < y.item group by 1, 2")
def j09_parts(t):
    own = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("item"))
    return J.pairs(own, "l_orderkey", "item").groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j09_pairs_in_blocks",
    """select x.c_nationkey, count(*) as n, sum(x.c_custkey)::bigint as sum_a, sum(y.c_custkey)::bigint as sum_b
    from customer x join customer y on x.c_nationkey = y.c_nationkey and x.c_custkey < y.c_custkey group by 1""",
)
def j09_blocks(t):
    """All pairs of a nation's customers; nations are heavy keys, of many blocks each."""
    met = J.pairs(t.customer, "c_nationkey", "c_custkey", block=20)
    return met.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("item_a").alias("sum_a"), F.sum("item_b").alias("sum_b"))


DAILY = "select user_id, cast(ts as date) as day, count(*) as n from events group by 1, 2"


@query("j10_next_vintage", f"with d as ({DAILY}), r as (select *, dense_rank() over (order by day) as k from d) select a.user_id, a.day, a.n, b.n as next_n from r a join r b on a.user_id = b.user_id and b.k = a.k + 1")
def j10(t):
    daily = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return J.next_vintage(daily, "user_id", "day").select("user_id", "day", "n", F.col("next.n").alias("next_n"))


@query("j11_within_radius", f"with a as ({CUSTOMERS}), b as ({SITES}) select c_custkey, s_suppkey, round({MILES}, 4) as miles from a, b where {MILES} <= 30")
def j11(t):
    return J.within_radius(places(t), sites(t), 30).select("c_custkey", "s_suppkey", F.round("miles", 4).alias("miles"))


#: Places in the far north, on both sides of the 180th meridian.
NORTH = "select c_custkey, cast(60 + (c_custkey * 7919 % 2400) / 100.0 as double) as lat, cast(case when (c_custkey * 104729) % 2000 < 1000 then 170 + (c_custkey * 104729) % 1000 / 100.0 else -180 + (c_custkey * 104729) % 1000 / 100.0 end as double) as lon from customer"
NORTH_SITES = NORTH.replace("c_custkey", "s_suppkey").replace("customer", "supplier").replace("lat,", "blat,").replace("as lon", "as blon")


@query("j11_within_radius_north", f"with a as ({NORTH}), b as ({NORTH_SITES}) select c_custkey, s_suppkey, round({MILES}, 4) as miles from a, b where {MILES} <= 60")
def j11_north(t):
    side = lambda df, sql: df.selectExpr(*[x.strip() for x in sql[len("select ") : sql.rindex(" from ")].split(", cast")][:1], *["cast" + x for x in sql[len("select ") : sql.rindex(" from ")].split(", cast")[1:]])
    return J.within_radius(side(t.customer, NORTH), side(t.supplier, NORTH_SITES), 60).select("c_custkey", "s_suppkey", F.round("miles", 4).alias("miles"))


@query(
    "j12_nearest",
    f"""with a as ({CUSTOMERS}), b as ({SITES}), m as (select c_custkey, s_suppkey, {MILES} as miles from a, b)
    select c_custkey, s_suppkey, round(miles, 4) as miles, rank from (select *, row_number() over (partition by c_custkey order by miles, s_suppkey) as rank from m) where rank <= 2""",
)
def j12(t):
    return J.nearest(places(t), "c_custkey", sites(t), "s_suppkey", 2).withColumn("miles", F.round("miles", 4)).withColumn("rank", F.col("rank").cast("long"))


GLOBE_LAT, GLOBE_LON = "cast(-90 + (c_custkey * 7919) % 18001 / 100.0 as double)", "cast(-180 + (c_custkey * 104729) % 36000 / 100.0 as double)"
GLOBE_BLAT = "cast(case when s_suppkey % 3 = 0 then 61 + s_suppkey % 90 / 100.0 when s_suppkey % 3 = 1 then -89.9 else s_suppkey % 50 end as double)"
GLOBE_BLON = "cast(case when s_suppkey % 2 = 0 then 179.9 - s_suppkey % 40 / 100.0 else -179.5 + s_suppkey % 360 end as double)"
GLOBE_C = f"select c_custkey, {GLOBE_LAT} as lat, {GLOBE_LON} as lon from customer"
GLOBE_S = f"select s_suppkey, s_acctbal, {GLOBE_BLAT} as blat, {GLOBE_BLON} as blon from supplier"


@query(
    "j12_nearest_globe",
    f"""with a as ({GLOBE_C}), b as ({GLOBE_S}), f as (select *, unnest(case when s_acctbal > 5000 then ['all', 'rich'] else ['all'] end) as "filter" from b),
    m as (select c_custkey, "filter", s_suppkey, {MILES} as miles from a, f)
    select c_custkey, "filter", s_suppkey, round(miles, 3) as miles, rank from (select *, row_number() over (partition by c_custkey, "filter" order by miles, s_suppkey) as rank from m) where rank <= 1""",
)
def j12_globe(t):
    """Places all over the globe, poles and the 180th meridian too, and sites in three dense lots; two filters at once."""
    a = t.customer.select("c_custkey", F.expr(GLOBE_LAT).alias("lat"), F.expr(GLOBE_LON).alias("lon"))
    b = t.supplier.select("s_suppkey", "s_acctbal", F.expr(GLOBE_BLAT).alias("blat"), F.expr(GLOBE_BLON).alias("blon"))
    met = J.nearest(a, "c_custkey", b, "s_suppkey", 1, {"all": F.lit(True), "rich": F.col("s_acctbal") > 5000})
    return met.withColumn("miles", F.round("miles", 3)).withColumn("rank", F.col("rank").cast("long"))


@query(
    "j13_resolve_parent",
    """select o.o_orderkey, o.o_custkey * 7 as parent, case when o.o_custkey * 7 = o.o_orderkey then 'self' when p.o_orderkey is not null then 'resolved' else 'dangling' end as state
    from orders o left join orders p on p.o_orderkey = o.o_custkey * 7""",
)
def j13(t):
    own = t.orders.select("o_orderkey", (F.col("o_custkey") * 7).alias("parent"))
    known = t.orders.select(F.col("o_orderkey").alias("parent"), F.lit(True).alias("known"))
    state = F.when(F.col("parent") == F.col("o_orderkey"), "self").when(F.col("known"), "resolved").otherwise("dangling")
    return own.join(known, "parent", "left").select("o_orderkey", "parent", state.alias("state"))


@query(
    "j14_prefix_fallback",
    """with d as (select code, row_number() over (order by code) as rate from (values ('1'), ('12'), ('123'), ('2'), ('34')) v(code)), o as (select o_orderkey, cast(o_orderkey as varchar) as code from orders)
    select o_orderkey, coalesce(d3.rate, d2.rate, d1.rate, 0) as rate, case when d3.rate is not null then 3 when d2.rate is not null then 2 when d1.rate is not null then 1 else 0 end as level
    from o left join d d3 on length(o.code) >= 3 and d3.code = substr(o.code, 1, 3) left join d d2 on length(o.code) >= 2 and d2.code = substr(o.code, 1, 2) left join d d1 on d1.code = substr(o.code, 1, 1)""",
)
def j14(t):
    dim = t.spark.createDataFrame([("1", 1), ("12", 2), ("123", 3), ("2", 4), ("34", 5)], "prefix string, rate long")
    own = t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("code"))
    return J.prefix_fallback(own, "code", F.broadcast(dim), "prefix", "rate", [3, 2, 1], 0).select("o_orderkey", "rate", F.col("level").cast("int").alias("level"))


@query(
    "j14_prefix_fallback_odd",
    """with d as (select code, row_number() over (order by code) as rate from (values ('123'), ('2'), ('34')) v(code)), o as (select l_orderkey, case when l_partkey % 3 > 0 then substr(cast(l_partkey as varchar), 1, l_linenumber % 4) end as code from lineitem)
    select l_orderkey, o.code, coalesce(d3.rate, d1.rate, 0) as rate, case when d3.rate is not null then 3 when d1.rate is not null then 1 else 0 end as level
    from o left join d d3 on length(o.code) >= 3 and d3.code = substr(o.code, 1, 3) left join d d1 on length(o.code) >= 1 and d1.code = substr(o.code, 1, 1)""",
)
def j14_odd(t):
    """Null, empty and short codes, and rows that repeat."""
    dim = t.spark.createDataFrame([("123", 1), ("2", 2), ("34", 3)], "prefix string, rate long")
    code = F.when(F.col("l_partkey") % 3 > 0, F.substring(F.col("l_partkey").cast("string"), F.lit(1), F.col("l_linenumber") % 4))
    own = t.lineitem.select("l_orderkey", code.alias("code"))
    return J.prefix_fallback(own, "code", dim, "prefix", "rate", [3, 1], 0).withColumn("level", F.col("level").cast("int"))


@query(
    "j15_match_ladder",
    """with m as (select c_custkey, s_suppkey, 1 as tier from customer join supplier on c_nationkey = s_nationkey and c_custkey % 10 = s_suppkey % 10
      union all select c_custkey, s_suppkey, 2 from customer join supplier on c_nationkey = s_nationkey),
    b as (select *, min(tier) over (partition by c_custkey) as best from m)
    select c_custkey, s_suppkey, tier, count(*) over (partition by c_custkey) as n_targets, row_number() over (partition by c_custkey order by s_suppkey) = 1 as is_canonical from b where tier = best""",
)
def j15(t):
    a = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 10).alias("digit"))
    b = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 10).alias("digit"))
    return J.match_ladder(a, "c_custkey", b, "s_suppkey", [("nation and digit", ["nation", "digit"]), ("nation", ["nation"])]).drop("tier_name")


@query(
    "j16_cascade",
    """with s1 as (select s_nationkey as n, s_suppkey % 10 as d, min(s_suppkey) as target from supplier group by 1, 2), s2 as (select s_nationkey as n, min(s_suppkey) as target from supplier group by 1)
    select c_custkey, coalesce(s1.target, s2.target) as target, case when s1.target is not null then 'strong' else 'weak' end as step from customer left join s1 on c_nationkey = s1.n and c_custkey % 10 = s1.d left join s2 on c_nationkey = s2.n where coalesce(s1.target, s2.target) is not null""",
)
def j16(t):
    a = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 10).alias("digit"))
    b = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 10).alias("digit"))
    return J.cascade(a, "c_custkey", b, "s_suppkey", [("strong", ["nation", "digit"]), ("weak", ["nation"])])


@query("j17_resolve_unique", "select l_orderkey, count(distinct l_suppkey) as n_targets, case when count(distinct l_suppkey) = 1 then min(l_suppkey) end as target, case when count(distinct l_suppkey) = 1 then 'unique' else 'ambiguous' end as status from lineitem group by 1")
def j17(t):
    return J.resolve_unique(t.lineitem, "l_orderkey", "l_suppkey")


FUZZY = "lpad(cast(s_suppkey as string), 9, '0') || ' SUPPLIER WORKS'"


@query(
    "j18_fuzzy_match",
    """with a as (select s_suppkey as k, lpad(cast(s_suppkey as varchar), 9, '0') || ' SUPPLIER WORKS' as n from supplier), b as (select s_suppkey as k, lpad(cast(s_suppkey as varchar), 9, '0') || ' SUPPLIER WORK' || (case when s_suppkey % 2 = 0 then 'S' else 'Z' end) as n from supplier),
    m as (select a.k as a_key, b.k as b_key, round(100.0 * (1 - levenshtein(a.n, b.n) / greatest(length(a.n), length(b.n))), 4) as similarity from a join b on split_part(a.n, ' ', 1) = split_part(b.n, ' ', 1))
    select a_key, b_key, similarity from (select *, row_number() over (partition by a_key order by similarity desc, b_key) as rn from m where similarity >= 95) where rn = 1""",
)
def j18(t):
    a = t.supplier.select(F.col("s_suppkey").alias("k"), F.expr(FUZZY).alias("n"))
    b = t.supplier.select(F.col("s_suppkey").alias("k"), F.expr(FUZZY.replace(" WORKS'", " WORK' || (case when s_suppkey % 2 = 0 then 'S' else 'Z' end)")).alias("n"))
    return J.fuzzy_match(a, "k", "n", b, "k", "n")


ONE_BLOCK = "'acme ' || md5(cast(c_custkey as {text}))"
DENTED = "case when c_custkey % 3 = 0 then 'acme ' || substr(md5(cast(c_custkey as {text})), 1, 20) || 'z' || substr(md5(cast(c_custkey as {text})), 22) when c_custkey % 3 = 1 then 'acme ' || substr(md5(cast(c_custkey as {text})), 2) else 'acme ' || md5(cast(c_custkey + 1 as {text})) end"


@query(
    "j18_fuzzy_one_block",
    f"""with a as (select c_custkey as k, {ONE_BLOCK.format(text='varchar')} as n from customer), b as (select c_custkey as k, {DENTED.format(text='varchar')} as n from customer),
    s as (select k, n, array_to_string(list_sort(string_split(n, ' ')), ' ') as t from a), u as (select k, n, array_to_string(list_sort(string_split(n, ' ')), ' ') as t from b),
    m as (select s.k as a_key, u.k as b_key, round(100.0 * (1 - levenshtein(s.t, u.t) / greatest(length(s.t), length(u.t))), 4) as similarity from s, u)
    select a_key, b_key, similarity from (select *, row_number() over (partition by a_key order by similarity desc, b_key) as rn from m where similarity >= 95) where rn = 1""",
)
def j18_one_block(t):
    """All names begin with one token, so that the block is the table: some equal, some a letter off, some shifted."""
    a = t.customer.select(F.col("c_custkey").alias("k"), F.expr(ONE_BLOCK.format(text="string")).alias("n"))
    b = t.customer.select(F.col("c_custkey").alias("k"), F.expr(DENTED.format(text="string")).alias("n"))
    return J.fuzzy_match(a, "k", "n", b, "k", "n")


J19_SQL = """with p as (select p_partkey, list_distinct(string_split(p_name || ' ' || lower(p_type), ' ')) as w from part), x as (select p_partkey, len(w) as n, unnest(w) as tok from p), a as (select * from x where p_partkey % 2 = 0), b as (select * from x where p_partkey % 2 = 1),
    m as (select a.p_partkey as a_part, b.p_partkey as b_part, count(*) as shared, count(*) / least(any_value(a.n), any_value(b.n)) as score from a join b using (tok) group by 1, 2)
    select a_part, b_part, shared, round(score, 6) as score, rank from (select *, row_number() over (partition by a_part order by score desc, shared desc, b_part) as rank from m) where rank <= 3"""


@query("j19_overlap_candidates", J19_SQL)
def j19(t):
    own = t.part.select("p_partkey", F.array_distinct(F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ")).alias("tokens"))
    a = own.filter("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "a_part")
    b = own.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "b_part")
    return J.overlap_candidates(a, "a_part", b, "b_part", 3).withColumn("score", F.round("score", 6)).withColumn("rank", F.col("rank").cast("long"))


@query(
    "j20_attribute_email",
    """with p as (select c_nationkey as org, c_custkey as person, 'c' || (c_custkey % 100) as last, 'f' || (c_custkey % 7) as first from customer), e as (select distinct org, first || '.' || last as local from p union select distinct org, last from p),
    m as (select org, local, person, case when local = first || '.' || last then 2 when local = last then 1 end as score from e join p using (org)),
    b as (select *, max(score) over (partition by org, local) as best from m where score is not null), u as (select *, count(*) over (partition by org, local) as n from b where score = best)
    select local || '@' || org as email, person, case score when 2 then 'first.last' else 'last' end as pattern, score from u where n = 1""",
)
def j20(t):
    p = t.customer.select(F.col("c_nationkey").alias("org"), F.col("c_custkey").alias("person"), F.concat(F.lit("c"), F.col("c_custkey") % 100).alias("last"), F.concat(F.lit("f"), F.col("c_custkey") % 7).alias("first"))
    e = p.select("org", F.concat_ws(".", "first", "last").alias("local")).union(p.select("org", "last")).distinct().withColumn("email", F.concat_ws("@", "local", F.col("org").cast("string")))
    both = {"first.last": F.concat_ws(".", "first", "last"), "last": F.col("last")}
    return J.attribute_email(e, p, "org", both).select("email", "person", "pattern", "score")


@query(
    "j21_chain_codes",
    """with c as (select p_partkey as start from part), one as (select start, start * 2 as code from c where start % 2 = 0 union all select start, start + 1 from c where start % 2 = 0 union all select start, start from c where start % 2 = 1)
    select distinct start, case when code % 3 = 0 then code + 10 else code end as code from one""",
)
def j21(t):
    k = F.col("p_partkey")
    first = t.part.filter("p_partkey % 2 = 0").select(k.alias("old"), F.explode(F.array(k * 2, k + 1)).alias("new"))
    every = t.part.select(k.alias("code")).union(first.select("new")).distinct()
    second = every.filter("code % 3 = 0").select("code", (F.col("code") + 10).alias("new"))
    return J.chain_codes({"r1": first, "r2": second}, t.part.select(k.alias("code")))


@query("j22_compose", "select distinct o_custkey, l_suppkey from orders join lineitem on o_orderkey = l_orderkey where o_orderstatus = 'F'")
def j22(t):
    return J.compose(t.orders.filter("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "hub"), t.lineitem.withColumnRenamed("l_orderkey", "hub"), "hub", "o_custkey", "l_suppkey")


@query("j23_explode_join", "with w as (select p_partkey, unnest(string_split(p_name, ' ')) as word from part), d as (select * from (values ('red', 'color'), ('blue', 'color'), ('gear', 'thing'), ('bolt', 'thing')) v(word, kind)) select p_partkey, word, kind from w join d using (word)")
def j23(t):
    dim = t.spark.createDataFrame([("red", "color"), ("blue", "color"), ("gear", "thing"), ("bolt", "thing")], "word string, kind string")
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word")).join(F.broadcast(dim), "word").select("p_partkey", "word", "kind")


@query(
    "j24_resolve_list",
    """with i as (select distinct o_custkey % 200 + 1400 as id from orders), s as (select c_custkey as id, c_nationkey as target, 'customer' as source from customer union all select s_suppkey + 1400, s_nationkey, 'supplier' from supplier),
    m as (select id, target, string_agg(distinct source, '+' order by source) as sources from i left join s using (id) group by 1, 2)
    select id, target, coalesce(sources, '') as sources, rank from (select *, row_number() over (partition by id order by length(coalesce(sources, '')) desc, target) as rank from m) where rank <= 2""",
)
def j24(t):
    ids = t.orders.select((F.col("o_custkey") % 200 + 1400).alias("id")).distinct()
    sources = {"customer": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("target")), "supplier": t.supplier.select((F.col("s_suppkey") + 1400).alias("id"), F.col("s_nationkey").alias("target"))}
    return J.resolve_list(ids, "id", sources, 2).withColumn("rank", F.col("rank").cast("long"))


