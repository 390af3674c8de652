"""Hierarchy, co-occurrence and place queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from recordloom.functions import geo
from recordloom.operators import aggregates as A
from recordloom.operators import graph as G
from recordloom.operators import joins as J

from .joins import BASKETS, CUSTOMERS, LAT_S, LON_S, MILES, PARTS, SITES, places, sites
from .registry import query

TREE = "e as (select c_custkey as child, cast(floor(c_custkey / 7) as bigint) as parent from customer where c_custkey > 0 union all select max(c_custkey) + 1, max(c_custkey) + 2 from customer union all select max(c_custkey) + 2, max(c_custkey) + 1 from customer)"
UP = f"with recursive {TREE}, w(node, ancestor, depth) as (select child, parent, 1 from e union all select w.node, e.parent, w.depth + 1 from w join e on e.child = w.ancestor where w.depth < 10 and w.node <> w.ancestor)"


def tree(t):
    top = t.customer.agg(F.max("c_custkey").alias("m"))
    loop = top.select(F.inline(F.array(F.struct((F.col("m") + 1).alias("child"), (F.col("m") + 2).alias("parent")), F.struct((F.col("m") + 2).alias("child"), (F.col("m") + 1).alias("parent")))))
    return t.customer.filter("c_custkey > 0").select(F.col("c_custkey").alias("child"), F.floor(F.col("c_custkey") / 7).alias("parent")).union(loop)


@query("h01_functional_edges", "with n as (select l_partkey, l_suppkey, count(*) as support from lineitem group by 1, 2) select l_partkey, l_suppkey, support from (select *, row_number() over (partition by l_partkey order by support desc, l_suppkey) as rn from n) where rn = 1")
def h01(t):
    return G.functional_edges(t.lineitem, "l_partkey", "l_suppkey")


@query(
    "h02_closure",
    f"""{UP}, c as (select distinct node as c from w where node = ancestor), l as (select node, arg_max(ancestor, depth) as last, max(depth) as depth from w group by 1), z as (select node, min(ancestor) as root from w where ancestor in (select c from c) group by 1)
    select l.node, coalesce(z.root, l.last) as root, case when z.root is null then l.depth end as depth, l.node in (select c from c) as in_cycle, coalesce(z.root is null and l.depth > 3, false) as capped from l left join z using (node)""",
)
def h02(t):
    return G.closure(tree(t), max_depth=3)


@query(
    "h02_closure_chains",
    "select child as node, min(child) filter (where parent is null) over (partition by o_custkey) as root, n as depth, false as in_cycle, false as capped from (select o_custkey, o_orderkey as child, lag(o_orderkey) over w as parent, cast(row_number() over w - 1 as integer) as n from orders window w as (partition by o_custkey order by o_orderkey)) qualify parent is not null",
)
def h02_chains(t):
    """Each order hangs on the customer's order before it: chains of dozens of steps."""
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return G.closure(t.orders.select(F.col("o_orderkey").alias("child"), before.alias("parent")).filter("parent is not null"))


@query(
    "h03_subtree_sum",
    f"""{UP}, v as (select o_custkey as k, sum(o_totalprice) as m from orders group by 1), a as (select distinct node, ancestor from w where node <> ancestor), u as (select k as node, m from v union all select ancestor, m from v join a on a.node = v.k)
    select node, round(sum(m), 2) as total, count(*) as members from u group by 1""",
)
def h03(t):
    v = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.sum("o_totalprice").alias("m"))
    return G.subtree_sum(tree(t), v, "k", "m")


@query(
    "h03_subtree_sum_chains",
    """select o_orderkey as node, round(sum(o_totalprice) over w, 2) as total, count(*) over w as members from orders
    window w as (partition by o_custkey order by o_orderkey rows between current row and unbounded following)""",
)
def h03_chains(t):
    """Each order hangs on the customer's order before it: what lies below is what came later."""
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    edges = t.orders.select(F.col("o_orderkey").alias("child"), before.alias("parent")).filter("parent is not null")
    return G.subtree_sum(edges, t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice")


H04_SQL = f"with {TREE}, a as (select c_custkey as k from customer), x as (select k as anchor, k as member, 0 as hops, k::varchar as path from a union all select k, child, 1, k || '>' || child from a join e on parent = k union all select k, f.child, 2, k || '>' || e.child || '>' || f.child from a join e on e.parent = k join e f on f.parent = e.child), r as (select *, row_number() over (partition by anchor, member order by hops, path) as rn from x) select anchor, member, hops, path from r where rn = 1"


@query("h04_family", H04_SQL)
def h04(t):
    return G.family(t.customer, "c_custkey", tree(t))


@query(
    "h05_edge_table",
    """with d as (select o_custkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag from orders join lineitem on o_orderkey = l_orderkey), m as (select o_custkey, l_suppkey, l_returnflag, count(*) as n from d group by 1, 2, 3), b as (select *, row_number() over (partition by o_custkey, l_suppkey order by n desc, l_returnflag) as rn from m)
    select d.o_custkey, d.l_suppkey, round(sum(l_extendedprice), 2) as total, count(*) as n, min(cast(l_shipdate as date)) as first_day, max(cast(l_shipdate as date)) as last_day, round(sum(case when cast(l_shipdate as date) > date '2001-12-01' - interval 60 month then l_extendedprice else 0 end), 2) as total_5y, any_value(b.l_returnflag) as modal_code
    from d join b on b.o_custkey = d.o_custkey and b.l_suppkey = d.l_suppkey and b.rn = 1 group by 1, 2""",
)
def h05(t):
    d = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return G.edge_table(d, "o_custkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "2001-12-01")


EDGES = f"b as ({BASKETS}), ed as (select x.item as item_a, y.item as item_b, count(*) as support from b x join b y using (l_orderkey) where x.item <> y.item group by 1, 2)"


def _items(t):
    return t.lineitem.select("l_orderkey", (F.col("l_partkey") % 50).alias("item"))


@query(
    "h06_cooccurrence",
    f"""with {EDGES}, n as (select item, count(*) as n from b group by 1), a as (select count(distinct l_orderkey) as a from b)
    select item_a, item_b, support, round(support / na.n, 6) as confidence, round(support * a / (na.n * nb.n), 6) as lift, round(support / (na.n + nb.n - support), 6) as jaccard from ed join n na on na.item = item_a join n nb on nb.item = item_b, a""",
)
def h06(t):
    return G.cooccurrence(_items(t), "l_orderkey", "item")


INFER = "inf as (select l_suppkey, item_b as item, count(*) as hits, sum(support)::bigint as support from held join ed on held.item = item_a where not exists (select 1 from held h where h.l_suppkey = held.l_suppkey and h.item = item_b) group by 1, 2)"


# On part keys, with all rows that a supplier holds.
PART_EDGES = EDGES.replace(BASKETS, PARTS)
PART_HELD = "held as (select distinct l_suppkey, l_partkey as item from lineitem)"


def _parts(t, key):
    return t.lineitem.select(key, F.col("l_partkey").alias("item"))


def _part_edges(t):
    return G.supports(_parts(t, "l_orderkey"), "l_orderkey", "item")


@query(
    "h06_cooccurrence_parts",
    f"""with {PART_EDGES}, n as (select item, count(*) as n from b group by 1), a as (select count(distinct l_orderkey) as a from b)
    select item_a, item_b, support, round(support / na.n, 6) as confidence, round(support * a / (na.n * nb.n), 6) as lift, round(support / (na.n + nb.n - support), 6) as jaccard from ed join n na on na.item = item_a join n nb on nb.item = item_b, a""",
)
def h06_parts(t):
    return G.cooccurrence(_parts(t, "l_orderkey"), "l_orderkey", "item")


H07_SQL = f"with {PART_EDGES}, {PART_HELD}, {INFER} select * from inf"


@query("h07_infer", H07_SQL)
def h07_parts(t):
    return G.infer(_parts(t, "l_suppkey"), "l_suppkey", "item", _part_edges(t))


H08_SQL = f"with {PART_EDGES}, {PART_HELD}, {INFER} select l_suppkey, item, hits, support, rank from (select *, row_number() over (partition by l_suppkey order by support desc, hits desc, item) as rank from inf) where rank <= 5"


@query("h08_recommend", H08_SQL)
def h08_parts(t):
    return G.recommend(_parts(t, "l_suppkey"), "l_suppkey", "item", _part_edges(t), 5).withColumn("rank", F.col("rank").cast("long"))


@query("h09_best_name", "with m as (select c_nationkey as node, c_mktsegment as name, 2 as priority from customer union all select s_nationkey, s_name, 1 from supplier where s_suppkey % 4 = 0), n as (select node, name, priority, count(*) as n from m group by 1, 2, 3) select node, name, priority from (select *, row_number() over (partition by node order by priority, n desc, name) as rn from n) where rn = 1")
def h09(t):
    m = t.customer.select(F.col("c_nationkey").alias("node"), F.col("c_mktsegment").alias("name"), F.lit(2).alias("priority")).union(t.supplier.filter("s_suppkey % 4 = 0").select("s_nationkey", "s_name", F.lit(1)))
    return G.best_name(m, "node", "name", "priority")


@query("g24_family_fold", f"{UP}, l as (select node, arg_max(ancestor, depth) as root from w where node not in (select node from w where node = ancestor) group by 1) select coalesce(root, o_custkey) as root, round(sum(o_totalprice), 2) as total, count(distinct o_custkey) as members from orders left join l on node = o_custkey group by 1")
def g24(t):
    roots = G.closure(tree(t)).filter("not in_cycle").select(F.col("node").alias("o_custkey"), "root")
    return A.family_fold(t.orders, "o_custkey", roots, "o_totalprice")


@query("e01_haversine", f"with a as ({CUSTOMERS}), b as ({SITES}) select c_custkey, round({MILES}, 4) as miles from a join b on s_suppkey = c_custkey % 100")
def e01(t):
    return places(t).join(sites(t), F.col("s_suppkey") == F.col("c_custkey") % 100).select("c_custkey", F.round(geo.haversine(F.col("lat"), F.col("lon"), F.col("blat"), F.col("blon")), 4).alias("miles"))


@query(
    "e02_geocode",
    f"""with p as ({CUSTOMERS}), z as (select c_nationkey as zip, avg(lat) as lat from p join customer using (c_custkey) where c_nationkey < 12 group by 1), r as (select n_regionkey as county, avg(lat) as lat from p join customer using (c_custkey) join nation on n_nationkey = c_nationkey group by 1)
    select c.c_custkey, round(coalesce(case when c.c_custkey % 3 = 0 then p.lat end, z.lat, r.lat), 9) as lat, case when c.c_custkey % 3 = 0 then 'address' when z.lat is not null then 'zip' when r.lat is not null then 'county' end as precision
    from customer c join p using (c_custkey) left join z on z.zip = c.c_nationkey join nation on n_nationkey = c.c_nationkey left join r on r.county = n_regionkey""",
)
def e02(t):
    from recordloom.functions.values import first_present

    own = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    known = own.join(places(t), "c_custkey")
    address = places(t).filter("c_custkey % 3 = 0").select("c_custkey", F.col("lat").alias("a"))
    zips = known.filter("c_nationkey < 12").groupBy("c_nationkey").agg(F.avg("lat").alias("z"))
    counties = known.groupBy("n_regionkey").agg(F.avg("lat").alias("r"))
    met = own.join(address, "c_custkey", "left").join(zips, "c_nationkey", "left").join(counties, "n_regionkey", "left")
    best = first_present(address=F.col("a"), zip=F.col("z"), county=F.col("r"))
    return met.select("c_custkey", best.alias("b")).select("c_custkey", F.round("b.value", 9).alias("lat"), F.col("b.source").alias("precision"))


@query("e03_centroid", f"with p as ({CUSTOMERS}) select c_nationkey, round(avg(lat), 9) as lat, round(avg(lon), 9) as lon from p join customer using (c_custkey) group by 1")
def e03(t):
    return places(t).join(t.customer, "c_custkey").groupBy("c_nationkey").agg(F.round(F.avg("lat"), 9).alias("lat"), F.round(F.avg("lon"), 9).alias("lon"))


@query("e04_proximity_rollup", f"with a as ({CUSTOMERS}), b as ({SITES}), m as (select c_custkey, s_suppkey from a, b where {MILES} <= 60) select c_custkey, count(*) as n, round(sum(s_acctbal), 2) as total, string_agg(s_suppkey, ',' order by cast(s_suppkey as varchar)) as keys from m join supplier using (s_suppkey) group by 1")
def e04(t):
    rich = t.supplier.select("s_acctbal", F.col("s_suppkey"), F.expr(LAT_S).alias("blat"), F.expr(LON_S).alias("blon"))
    return J.proximity_rollup(places(t), rich, 60, "s_suppkey", "s_acctbal").select("c_custkey", "n", "total", "keys")


def _squares(t):
    corner = lambda dx, dy: F.concat((F.col("blon") + dx).cast("decimal(12,4)").cast("string"), F.lit(" "), (F.col("blat") + dy).cast("decimal(12,4)").cast("string"))
    wkt = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(0, 0), corner(0.5, 0), corner(0.5, 0.5), corner(0, 0.5), corner(0, 0)), F.lit("))"))
    return sites(t).withColumn("wkt", wkt)


@query("e05_wkt_centroid", f"with b as ({SITES}) select s_suppkey, round(blon + 0.25, 4) as lon, round(blat + 0.25, 4) as lat from b")
def e05(t):
    return _squares(t).select("s_suppkey", geo.wkt_centroid(F.col("wkt")).alias("c")).select("s_suppkey", F.round("c.lon", 4).alias("lon"), F.round("c.lat", 4).alias("lat"))


@query("e05_wkt_centroid_parts", f"with b as ({SITES}) select s_suppkey, round(blon + 0.25 + 0.25 * 5 / 0.5, 4) as lon, round(blat + 0.25, 4) as lat from b")
def e05_parts(t):
    """Two squares, five degrees apart, with a hole in the middle of each."""
    corner = lambda dx, dy: F.concat((F.col("blon") + dx).cast("decimal(12,4)").cast("string"), F.lit(" "), (F.col("blat") + dy).cast("decimal(12,4)").cast("string"))
    square = lambda x, y, w, way: F.concat(F.lit("("), F.concat_ws(", ", *[corner(x + dx * w, y + dy * w) for dx, dy in [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)][::way]]), F.lit(")"))
    part = lambda x, way: F.concat(F.lit("("), square(x, 0, 0.5, 1), F.lit(", "), square(x + 0.125, 0.125, 0.25, way), F.lit(")"))
    wkt = F.concat(F.lit("MULTIPOLYGON ("), part(0, 1), F.lit(", "), part(5, -1), F.lit(")"))
    return sites(t).select("s_suppkey", geo.wkt_centroid(wkt).alias("c")).select("s_suppkey", F.round("c.lon", 4).alias("lon"), F.round("c.lat", 4).alias("lat"))


@query("e06_map_rows", f"with p as ({CUSTOMERS}) select o_orderkey, o_custkey, lat, lon, o_totalprice from orders join p on o_custkey = c_custkey where o_orderstatus = 'O' and o_totalprice > 200000 and lat between 30 and 45")
def e06(t):
    return t.orders.filter("o_orderstatus = 'O' and o_totalprice > 200000").join(places(t).filter("lat between 30 and 45"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_custkey", "lat", "lon", "o_totalprice")


@query(
    "e07_near_polygon",
    f"""with a as ({CUSTOMERS}), b as ({SITES}), d as (select c_custkey, s_suppkey, sqrt(pow(greatest(blon - lon, 0, lon - blon - 0.5), 2) + pow(greatest(blat - lat, 0, lat - blat - 0.5), 2)) as degrees from a, b)
    select c_custkey, s_suppkey, round(degrees, 6) as degrees from d where degrees <= 0.2""",
)
def e07(t):
    met = J.near_polygon(places(t), _squares(t), "wkt", 0.2)
    return met.select("c_custkey", "s_suppkey", F.round("degrees", 6).alias("degrees"))
