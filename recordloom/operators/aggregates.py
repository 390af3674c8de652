"""Rollups per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rollup(df: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    """Grouped aggregates by name."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def agg_if(value: Column, condition: Column, how=F.sum) -> Column:
    """Aggregate over the rows that meet a condition."""
    return how(F.when(condition, value))


def latest_value(df: DataFrame, key: str, col: str, order: Sequence[str]) -> DataFrame:
    """Value of the row that is last in a total order."""
    return df.groupBy(key).agg(F.max_by(col, F.struct(*order)).alias(col))


def quantiles(df: DataFrame, keys: Sequence[str], col: str, **ps: float) -> DataFrame:
    """Exact interpolated quantiles."""
    return df.groupBy(*keys).agg(*[F.percentile(col, p).alias(n) for n, p in ps.items()])


def mode_by(df: DataFrame, key: str, col: str) -> DataFrame:
    """Most frequent value, the least one on ties."""
    n = df.filter(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(col).alias("v"))).alias("b"))
    return best.select(key, F.col("b.v").alias(col), (-F.col("b.m")).alias("n"))


def collect(df: DataFrame, key: str, col: str, separator: str = ",") -> DataFrame:
    """Distinct values in order, as one text."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.col(col).cast("string"))), separator).alias(col))


def nest(df: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """Child rows as an ordered array of structs."""
    row = F.struct(*order, *[f for f in fields if f not in order])
    ordered = F.array_sort(F.collect_list(row))
    return df.groupBy(key).agg(F.transform(ordered, lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias(name))


def top_n_nested(df: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str], n: int, name: str) -> DataFrame:
    """The first n child rows nested, beside the count of all (G11). Rows are cut before they are nested."""
    w = Window.partitionBy(key)
    ranked = df.withColumn("_rn", F.row_number().over(w.orderBy(*order))).withColumn("_all", F.count(F.lit(1)).over(w)).filter(F.col("_rn") <= n)
    out = ranked.groupBy(key).agg(F.first("_all").alias(f"n_{name}"), F.array_sort(F.collect_list(F.struct("_rn", *fields))).alias("_l"))
    return out.select(key, f"n_{name}", F.transform("_l", lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias(name))


def trajectory_map(df: DataFrame, key: str, year: str, value: str, name: str = "by_year") -> DataFrame:
    """JSON object year -> sum."""
    per = df.groupBy(key, year).agg(F.round(F.sum(value), 2).alias("_v"))
    return per.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(year).cast("string"), "_v"))))).alias(name))


def windowed(df: DataFrame, key: str, day: str, measure: str, months: Sequence[int], as_of: str) -> DataFrame:
    """Sums and counts over trailing windows that end at a day, and over all time up to it."""
    end = F.to_date(F.lit(as_of))
    at = F.col(day).cast("date")
    own = df.filter(at <= end)
    out = []
    for m in months:
        inside = at > F.add_months(end, -m)
        out += [F.round(F.sum(F.when(inside, F.col(measure)).otherwise(0)), 2).alias(f"sum_{m}m"), F.count(F.when(inside, 1)).alias(f"n_{m}m")]
    return own.groupBy(key).agg(*out, F.round(F.sum(measure), 2).alias("sum_all"), F.count(F.lit(1)).alias("n_all"))


def growth(df: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """First and last active year, their sums, yearly growth rate between and over the last year."""
    per = df.groupBy(key, year).agg(F.sum(value).alias("_v"))
    prior = F.max(F.when(F.col(year) == F.col("_last") - 1, F.col("_v")))
    lasts = per.withColumn("_last", F.max(year).over(Window.partitionBy(key)))
    out = lasts.groupBy(key).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.min_by("_v", year).alias("_a"), F.max_by("_v", year).alias("_b"), prior.alias("_p"))
    span = F.col("last_year") - F.col("first_year")
    cagr = F.when((span > 0) & (F.col("_a") > 0), F.pow(F.col("_b") / F.col("_a"), 1.0 / span) - 1)
    return out.select(key, "first_year", "last_year", F.round(cagr, 6).alias("cagr"), F.round(F.col("_b") / F.nullif("_p", F.lit(0.0)) - 1, 6).alias("yoy"))


def top_share(df: DataFrame, key: str, partner: str, value: str) -> DataFrame:
    """Largest partner, the least one on ties, and its share of the key's value."""
    per = df.groupBy(key, partner).agg(F.sum(value).alias("_v"))
    out = per.groupBy(key).agg(F.min(F.struct((-F.col("_v")).alias("_n"), F.col(partner).alias("_p"))).alias("b"), F.sum("_v").alias("_t"), F.count(F.lit(1)).alias("n_partners"))
    return out.select(key, F.col("b._p").alias("top_partner"), F.round(-F.col("b._n") / F.nullif("_t", F.lit(0.0)), 6).alias("top_share"), "n_partners")


def pivot_flags(df: DataFrame, key: str, category: str, values: Sequence[str]) -> DataFrame:
    """A count column for each category."""
    out = df.groupBy(key).pivot(category, list(values)).agg(F.count(F.lit(1)))
    return out.select(key, *[F.coalesce(F.col(v), F.lit(0)).alias(f"n_{v}") for v in values])


def bands(df: DataFrame, col: str, edges: Sequence[float], measure: str) -> DataFrame:
    """Count and sum in [edge, next edge); band 0 is below the first."""
    number = F.lit(0)
    for e in edges:
        number = number + (F.col(col) >= e).cast("int")
    return df.filter(F.col(col).isNotNull()).groupBy(number.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(measure), 2).alias("total"))


def funnel(df: DataFrame, measure: str, steps: Mapping[str, Column]) -> DataFrame:
    """Rows and sums left after each further condition, in one pass."""
    cols, left = [], F.lit(True)
    for name, c in steps.items():
        left = left & F.coalesce(c, F.lit(False))
        cols.append(F.struct(F.lit(len(cols) + 1).alias("step"), F.lit(name).alias("name"), F.count(F.when(left, 1)).alias("n"), F.round(F.sum(F.when(left, F.col(measure)).otherwise(0)), 2).alias("total")))
    return df.agg(F.array(*cols).alias("r")).select(F.inline("r"))


def month_rollup(df: DataFrame, dims: Sequence[str], day: str, measure: str) -> DataFrame:
    """Count and sum by month."""
    month = F.trunc(F.col(day).cast("date"), "month").alias("month")
    return df.groupBy(*dims, month).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(measure), 2).alias("total"))


def stack_grains(df: DataFrame, grains: Mapping[str, Sequence[str]], measure: str) -> DataFrame:
    """The same measure at several grains, stacked; one scan, expanded by grain."""
    rows = F.array(*[F.struct(F.lit(n).alias("grain"), F.concat_ws("|", *cols).alias("code")) for n, cols in grains.items()])
    return df.select(measure, F.inline(rows)).groupBy("grain", "code").agg(F.round(F.sum(measure), 2).alias("total"), F.count(F.lit(1)).alias("n"))


def merge_rollups(key: str, *parts: DataFrame) -> DataFrame:
    """Rollups of several sources beside each key that any has, numbers zero where absent."""
    joined = reduce(lambda a, b: a.join(b, key, "full"), parts)
    return joined.fillna(0, [c for c in joined.columns if c != key])


def allocate(df: DataFrame, group: str, total: str, weight: str | None = None) -> DataFrame:
    """A group's total over its members, by weight or equally."""
    w = Window.partitionBy(group)
    part = F.col(weight) / F.sum(weight).over(w) if weight else 1.0 / F.count(F.lit(1)).over(w)
    return df.withColumn("allocated", F.col(total) * part)


def family_fold(df: DataFrame, key: str, roots: DataFrame, measure: str) -> DataFrame:
    """Sums and members per root; a key without a root is its own (G24). roots: key, root."""
    own = df.join(roots.select(key, "root"), key, "left")
    return own.groupBy(F.coalesce("root", key).alias("root")).agg(F.round(F.sum(measure), 2).alias("total"), F.count_distinct(key).alias("members"))


def expiry_calendar(df: DataFrame, end: str, measure: str, as_of: str) -> DataFrame:
    """Items that end from a day on, by end month."""
    return month_rollup(df.filter(F.col(end).cast("date") >= F.to_date(F.lit(as_of))), [], end, measure)


def consensus(df: DataFrame, key: str, col: str) -> DataFrame:
    """Value that all rows of a key agree on; other keys absent."""
    return df.groupBy(key).agg(F.count_distinct(col).alias("_n"), F.min(col).alias(col)).filter("_n = 1").drop("_n")
