"""Source operators over the tables, written in a format and read back by it."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from recordloom.sources import readers as R
from recordloom.sources.scratch import folder

from .registry import Tables, query

CUSTOMER_SQL = "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment from customer"


def _customer(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")


@query("s01_read_delimited", CUSTOMER_SQL)
def s01(t):
    path = folder(t.spark)
    _customer(t).write.csv(path, header=True, compression="gzip")
    return R.read_delimited(t.spark, path, ["c_custkey", "c_name", "c_mktsegment"])


def _ragged(t: Tables):
    path = folder(t.spark)
    fields = [F.col("c_custkey").cast("string"), F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""Inc"""'))]
    line = F.when(F.col("c_custkey") % 10 == 0, F.concat_ws(",", *fields, "c_mktsegment", F.lit("extra"))).when(F.col("c_custkey") % 10 == 1, F.concat_ws(",", *fields)).when(F.col("c_custkey") % 10 == 2, F.concat_ws(",", fields[0], F.lit('"open'), "c_mktsegment")).otherwise(F.concat_ws(",", *fields, "c_mktsegment"))
    t.customer.select(line.alias("value")).write.text(path)
    return R.read_ragged(t.spark, path, ["c_custkey", "c_name", "c_mktsegment"])


@query("s02_read_ragged", "select cast(c_custkey as varchar) as c_custkey, c_name || ', \"Inc\"' as c_name, case when c_custkey % 10 <> 1 then c_mktsegment end as c_mktsegment from customer where c_custkey % 10 not in (0, 2)")
def s02(t):
    return _ragged(t)[0]


@query("s02_read_ragged_rejects", "select case when c_custkey % 10 = 0 then c_custkey || ',\"' || c_name || ', \"\"Inc\"\"\",' || c_mktsegment || ',extra' else c_custkey || ',\"open,' || c_mktsegment end as line from customer where c_custkey % 10 in (0, 2)")
def s02_rejects(t):
    return _ragged(t)[1]


@query("s03_read_fixed_width", CUSTOMER_SQL)
def s03(t):
    path = folder(t.spark)
    c = _customer(t)
    c.select(F.concat(F.lpad("c_custkey", 12, " "), F.rpad("c_name", 24, " "), F.rpad("c_mktsegment", 16, " ")).alias("value")).write.text(path)
    return R.read_fixed_width(t.spark, path, {"c_custkey": (1, 12), "c_name": (13, 24), "c_mktsegment": (37, 16)})


@query(
    "s04_split_positional",
    """select case when c_custkey % 2 = 0 then 3 else 4 end as width, cast(c_custkey as varchar) as id, c_mktsegment as segment,
       case when c_custkey % 2 = 1 then cast(c_nationkey as varchar) end as nation from customer""",
)
def s04(t):
    even = F.col("c_custkey") % 2 == 0
    line = F.when(even, F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment")).otherwise(F.concat_ws("|", "c_custkey", "c_nationkey", "c_name", "c_mktsegment"))
    return R.split_positional(t.customer.select(line.alias("line")), "line", r"\|", {3: {"id": 0, "segment": 2}, 4: {"id": 0, "nation": 1, "segment": 3}})


@query("s05_read_copy_text", "select o_orderkey, case when o_orderkey % 7 <> 0 then o_orderpriority || chr(9) || chr(92) || 'n' end as o_orderpriority, cast(o_orderdate as date) as o_orderdate from orders")
def s05(t):
    path = folder(t.spark)
    null = F.lit("\\N")
    row = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 7 != 0, F.concat("o_orderpriority", F.lit("\\t\\\\n"))).otherwise(null), F.col("o_orderdate").cast("date").cast("string"))
    # every file ends at its mark; what follows is no data
    rows = t.orders.select(row.alias("value"), F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("n"))
    ends = t.spark.range(8).select(F.explode(F.array(F.lit("\\."), F.lit("1\tafter the end"))).alias("value"), F.col("id").cast("int").alias("p"), F.lit(1 << 62).alias("n"))
    rows.union(ends).repartition(8, F.pmod("p", F.lit(8))).sortWithinPartitions(F.pmod("p", F.lit(8)), "n", F.desc("value")).select("value", F.pmod("p", F.lit(8)).alias("p")).write.partitionBy("p").text(path)
    return R.read_copy_text(t.spark, path, "o_orderkey long, o_orderpriority string, o_orderdate date")


@query("s06_read_parquet", "select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem where l_shipdate >= timestamp '1998-01-01' group by 1")
def s06(t):
    own = R.read_parquet(t.spark, f"{t.folder}/lineitem.parquet").filter("l_shipdate >= timestamp '1998-01-01'")
    return own.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("s07_read_ndjson", "select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as k from events")
def s07(t):
    path = folder(t.spark)
    t.events.select("event_id", "event_type", F.from_json("props", "k long").alias("props")).write.json(path)
    rows = R.read_ndjson(t.spark, path, "event_id long, event_type string, props string")
    return rows.select("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("s08_read_xml", "select n_nationkey, n_name, n_regionkey from nation")
def s08(t):
    path = folder(t.spark)
    t.nation.write.format("xml").option("rootTag", "nations").option("rowTag", "nation").save(path)
    return R.read_xml(t.spark, path, "nation", "n_nationkey int, n_name string, n_regionkey int")


@query("s09_explode_nested", "select o_orderkey, l_partkey, l_quantity from orders join lineitem on o_orderkey = l_orderkey where l_partkey % 10 = 3")
def s09(t):
    path = folder(t.spark)
    items = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_quantity")).alias("items"))
    t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "items").write.json(path)
    doc = R.read_ndjson(t.spark, path, "o_orderkey long, items array<struct<l_partkey:long,l_quantity:double>>")
    flat = R.explode_nested(doc, ("items", "item"), keys=t.part.filter("p_partkey % 10 = 3").select("p_partkey"), key="item.l_partkey")
    return flat.select("o_orderkey", "item.l_partkey", "item.l_quantity")


def _as_document(rows):
    """Each partition's JSON rows as the array of one document, other fields and braces in strings around it."""
    first = True
    for batch in rows:
        values = batch["value"].tolist()
        if first:
            yield pd.DataFrame({"value": ['{"about": {"title": "orders } of [\\"all\\"", "items": [{"o": 0}]}, "orders": [']})
        yield pd.DataFrame({"value": [("" if first and i == 0 else ",") + v for i, v in enumerate(values)]})
        first = first and not values
    if not first:
        yield pd.DataFrame({"value": ['], "more": [{"o": 1, "items": []}]}']})


@query("s09_read_elements", "select o_orderkey, l_partkey, l_quantity from orders join lineitem on o_orderkey = l_orderkey where o_orderkey % 3 = 1")
def s09_elements(t):
    """Documents of one line each, read by byte ranges; orders are filtered before their items are parsed."""
    path = folder(t.spark)
    items = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_quantity")).alias("items"))
    rows = t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(F.to_json(F.struct("o_orderkey", F.lit('}{"[').alias("note"), "items")).alias("value"))
    rows.mapInPandas(_as_document, "value string").write.option("lineSep", " ").text(path)
    wanted = t.orders.filter("o_orderkey % 3 = 1").select("o_orderkey")
    flat = R.read_elements(t.spark, path, ["orders"], "o_orderkey long, items array<struct<l_partkey:long,l_quantity:double>>", wanted, "o_orderkey")
    return flat.select("o_orderkey", F.inline("items"))


@query("s10_read_jdbc", "select o_orderkey, o_custkey from orders where o_orderkey % 4 in (1, 3)")
def s10(t):
    """A table of the Derby that Spark brings along, on a local master; elsewhere a database that executors reach."""
    url, table = f"jdbc:derby:memory:recordloom{uuid.uuid4().hex};create=true", "ORDERS"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 4).alias("lot")).write.jdbc(url, table, mode="overwrite", properties=driver)
    return R.read_jdbc(t.spark, url, table, ['"lot" = 1', '"lot" = 3'], driver).select("o_orderkey", "o_custkey")


@query("s11_melt_crosstab", "select o_orderpriority, cast(year(o_orderdate) as varchar) as year, count(*) as n from orders group by 1, 2")
def s11(t):
    years = [str(y) for y in range(1995, 2002)]
    wide = t.orders.withColumn("y", F.year("o_orderdate").cast("string")).groupBy("o_orderpriority").pivot("y", years).count()
    return R.melt_crosstab(wide, ["o_orderpriority"], years, "year", "n")


SHEET_SQL = "with n as (select o_orderpriority as label, year(o_orderdate) as y, count(*) as n from orders group by 1, 2) select label, cast(y as varchar) as year, n::double as value from n"


@query("s11_melt_sheet", SHEET_SQL)
def s11_sheet(t):
    """A sheet with a title above the header, marks at labels, an empty row and a footnote."""
    years = [str(y) for y in range(1995, 2002)]
    wide = t.orders.withColumn("y", F.year("o_orderdate").cast("string")).groupBy("o_orderpriority").pivot("y", years).count()
    texts = [F.format_number(F.col(y), 0) for y in years]
    sheet = lambda n, *cells: F.struct(F.lit(n).alias("row_no"), F.array(*cells).alias("cells"))
    frame = t.spark.range(1).select(F.inline(F.array(sheet(0, F.lit("Orders by priority, 1995 on")), sheet(2, F.lit("Priority"), *[F.lit(f"FY {y}" if y == "1995" else y) for y in years]), sheet(90, F.lit("")), sheet(91, F.lit("1/ Counted by day of order, 2001 in part.")))))
    rows = wide.select(F.lit(10).alias("row_no"), F.array(F.concat("o_orderpriority", F.lit(" 1/")), *texts).alias("cells"))
    return R.melt_sheet(frame.union(rows))


@query("s12_read_window", "select event_id, user_id from events where ts >= date '2024-01-08' and ts < date '2024-01-15'")
def s12(t):
    return R.read_window(t.events, "ts", "2024-01-10", "2024-01-15", overlap_days=2).select("event_id", "user_id")


@query("s13_read_snapshot", "select o_orderkey, year(o_orderdate) as snapshot from orders where year(o_orderdate) = (select max(year(o_orderdate)) from orders where year(o_orderdate) <= 1999)")
def s13(t):
    path = folder(t.spark)
    t.orders.select("o_orderkey", F.year("o_orderdate").alias("snapshot")).write.partitionBy("snapshot").parquet(path)
    return R.read_snapshot(R.read_parquet(t.spark, path), "snapshot", as_of=1999)


@query("s14_read_documents", "select doc_id, sha256(text) as content_hash from documents")
def s14(t):
    return R.with_content_hash(t.documents, "text").select("doc_id", "content_hash")
