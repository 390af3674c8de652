"""Data-quality gates. Each gives rows that say what was found; callers decide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def gate_counts(metrics: DataFrame, baseline: DataFrame, floors: Mapping[str, int], tolerance: float) -> DataFrame:
    """metric, value, base, passed: floors and relative change against the last good run (Q01). Both: metric, value."""
    floor = F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(v))])
    both = metrics.join(baseline.select("metric", F.col("value").alias("base")), "metric", "left")
    steady = F.coalesce(F.abs(F.col("value") - F.col("base")) <= F.col("base") * tolerance, F.lit(True))
    return both.withColumn("passed", (F.col("value") >= F.coalesce(F.try_element_at(floor, F.col("metric")), F.lit(0))) & steady)


def gate_fractions(df: DataFrame, rules: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """rule, fraction, passed: share of rows for which a condition holds (Q02)."""
    cols = [F.struct(F.lit(n).alias("rule"), F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6).alias("fraction"), F.lit(float(least)).alias("least")) for n, (c, least) in rules.items()]
    return df.agg(F.array(*cols).alias("r")).select(F.inline("r")).withColumn("passed", F.col("fraction") >= F.col("least"))


def gate_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat, with their count (Q03)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def gate_fusion(df: DataFrame, group: str, hard_id: str) -> DataFrame:
    """Groups that span more than one hard id (Q04)."""
    return df.groupBy(group).agg(F.count_distinct(hard_id).alias("n_ids")).filter("n_ids > 1")


def coverage(detail: DataFrame, spine: DataFrame, key: str) -> DataFrame:
    """keys, found, share of the detail's distinct keys (Q05)."""
    own = detail.select(key).distinct().join(spine.select(key).distinct().withColumn("_f", F.lit(1)), key, "left")
    return own.agg(F.count(F.lit(1)).alias("keys"), F.count("_f").alias("found")).withColumn("share", F.round(F.col("found") / F.col("keys"), 6))


def parity(a: DataFrame, b: DataFrame, measures: Sequence[str]) -> DataFrame:
    """measure, a, b, equal: counts and sums of two tables (Q06)."""

    def sums(df: DataFrame) -> DataFrame:
        cols = [F.struct(F.lit("rows").alias("measure"), F.count(F.lit(1)).cast("double").alias("v"))]
        cols += [F.struct(F.lit(m).alias("measure"), F.round(F.sum(F.col(m).cast("double")), 2).alias("v")) for m in measures]
        return df.agg(F.array(*cols).alias("r")).select(F.inline("r"))

    return sums(a).withColumnRenamed("v", "a").join(sums(b).withColumnRenamed("v", "b"), "measure").withColumn("equal", F.col("a") == F.col("b"))


PRIME = (1 << 61) - 1


def digest(df: DataFrame) -> DataFrame:
    """Row count and an order-free digest of a table (Q07).

    A row is its fields in turn, each with its type and its length before it, nulls as a mark of their own;
    nested values are their JSON. Its hash is cut into four numbers of 32 bits, and each is added over all
    rows modulo a prime: no order or partition matters, and rows that repeat count.
    """

    def field(c: str, kind: str) -> Column:
        nested = kind.startswith(("array", "struct", "map"))
        text = F.to_json(F.col(f"`{c}`"), {"ignoreNullFields": "false"}) if nested else F.col(f"`{c}`").cast("string")
        return F.when(F.col(f"`{c}`").isNull(), f"{kind}~").otherwise(F.concat(F.lit(f"{kind}:"), F.length(text).cast("string"), F.lit(":"), text))

    row = F.sha2(F.concat(*[field(c, kind) for c, kind in df.dtypes]), 256)
    parts = [F.conv(F.substring("_h", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.pmod(F.coalesce(F.sum(x), F.lit(0)), F.lit(PRIME)).cast("long").cast("string") for x in parts]
    return df.select(row.alias("_h")).agg(F.count(F.lit(1)).alias("n"), F.concat_ws("-", *sums).alias("digest"))


def gate_schema(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """column, a, b, same: types by name (Q08)."""
    left, right = dict(a.dtypes), dict(b.dtypes)
    rows = [(c, left.get(c), right.get(c), left.get(c) == right.get(c)) for c in sorted({*left, *right})]
    return spark.createDataFrame(rows, "column string, a string, b string, same boolean")


JOINS = ("BroadcastNestedLoopJoin", "CartesianProduct")


def gate_plan(df: DataFrame) -> list[str]:
    """Nested-loop and cross joins in the physical plan (Q09)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [n for n in JOINS if n in plan]


def gate_plans(spark: SparkSession, plans: Mapping[str, DataFrame]) -> DataFrame:
    """plan, joins, passed: the gate over several plans; none of them runs (Q09)."""
    rows = [(n, ",".join(found), not found) for n, found in ((n, gate_plan(df)) for n, df in plans.items())]
    return spark.createDataFrame(rows, "plan string, joins string, passed boolean")


SLICES = 256


def profile(df: DataFrame, cols: Sequence[str], top: int = 3) -> DataFrame:
    """column, n, nulls, n_distinct, null_rate, least, most, quartiles of what is a number, top values with
    their counts, from counts of unpivoted values (Q10). Quartiles are exact to 1 in 10,000 ranks."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("k"))
    number = F.percentile_approx(F.col("value").try_cast("double"), [0.25, 0.5, 0.75], 10_000)
    base = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("nulls"), F.min("value").alias("least"), F.max("value").alias("most"), number.alias("quartiles"))
    # the top of each slice of a column's values first, then the top of those: no task ranks them all
    order = lambda *by: Window.partitionBy("column", *by).orderBy(F.desc("k"), "value")
    present = counts.filter("value is not null").withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(SLICES)))
    least = present.withColumn("rank", F.row_number().over(order("slice"))).filter(F.col("rank") <= top)
    ranked = least.withColumn("rank", F.row_number().over(order())).filter(F.col("rank") <= top)
    best = present.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct")).join(
        ranked.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "k"))).alias("b")), "column"
    )
    named = F.array_join(F.transform("b", lambda r: F.concat_ws(":", r["value"], r["k"].cast("string"))), ",")
    out = base.join(best.select("column", "n_distinct", named.alias("top")), "column", "left")
    return out.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0))).withColumn("null_rate", F.round(F.col("nulls") / F.col("n"), 6))


def stale_feeds(ledger: DataFrame, as_of: str, max_days: int) -> DataFrame:
    """Feeds whose last success is too old, or whose last run failed (Q11). ledger: feed, run_at, status."""
    last = ledger.groupBy("feed").agg(F.max_by("status", "run_at").alias("last_status"), F.max(F.when(F.col("status") == "ok", F.col("run_at"))).alias("last_ok"))
    age = F.datediff(F.to_date(F.lit(as_of)), F.col("last_ok").cast("date"))
    return last.withColumn("age_days", age).filter((F.col("last_status") != "ok") | F.col("last_ok").isNull() | (age > max_days))


def reconcile(expected: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """key, state: matched, missing or orphan (Q12)."""
    a, b = expected.select(key).distinct().withColumn("_e", F.lit(True)), landed.select(key).distinct().withColumn("_l", F.lit(True))
    return a.join(b, key, "full").select(key, F.when(F.col("_l").isNull(), "missing").when(F.col("_e").isNull(), "orphan").otherwise("matched").alias("state"))


def catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, position, column, type: a row per column of every table (Q13)."""
    rows = [(t, i, f.name, f.dataType.simpleString()) for t, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "dataset string, position int, column string, type string")


def fill_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The catalog with each table's rows and each column's values that are present (Q13)."""
    filled = None
    for name, df in tables.items():
        cells = [F.struct(F.lit(c).alias("column"), F.count(c).alias("present")) for c in df.columns]
        own = df.agg(F.count(F.lit(1)).alias("n"), F.array(*cells).alias("c")).select(F.lit(name).alias("dataset"), "n", F.inline("c"))
        filled = own if filled is None else filled.unionByName(own)
    return catalog(spark, tables).join(filled, ["dataset", "column"])
