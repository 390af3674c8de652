"""Scores, cohorts, samples, packs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookalike(held: DataFrame, entity: str, code: str, seeds: DataFrame, min_hits: int = 2, k: int | None = None) -> DataFrame:
    """entity, hits, score: entities that hold the seeds' codes, rare codes weighing more; seeds excluded."""
    own = held.select(entity, code).distinct()
    signature = own.join(seeds, entity, "left_semi").select(code).distinct()
    weight = own.groupBy(code).agg((1 / F.log(2.0 + F.count(F.lit(1)))).alias("w"))
    met = own.join(seeds, entity, "left_anti").join(signature.join(weight, code), code)
    out = met.groupBy(entity).agg(F.count(F.lit(1)).alias("hits"), F.round(F.sum("w"), 6).alias("score")).filter(F.col("hits") >= min_hits)
    return out.orderBy(F.desc("score"), entity).limit(k) if k else out


def cold_start(declared: DataFrame, entity: str, code: str, nodes: DataFrame, done: DataFrame, n: int, strong: float | None = None, partners: DataFrame | None = None, top: int = 3) -> DataFrame:
    """Top n realised combos of entities without history, by ln(1 + n) (X02). nodes: code, combo, n.

    strong: scores from it on are tier 1, others 2. partners (combo, partner, n): the top ones by n go
    beside each combo as text.
    """
    fresh = declared.select(entity, code).distinct().join(done, entity, "left_anti")
    met = fresh.join(nodes, code).groupBy(entity, "combo").agg(F.round(F.sum(F.log1p("n")), 6).alias("score"))
    w = Window.partitionBy(entity).orderBy(F.desc("score"), "combo")
    out = met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    if strong is not None:
        out = out.withColumn("tier", F.when(F.col("score") >= strong, 1).otherwise(2))
    if partners is not None:
        per = partners.groupBy("combo", "partner").agg(F.sum("n").alias("n"))
        best = per.withColumn("_r", F.row_number().over(Window.partitionBy("combo").orderBy(F.desc("n"), "partner"))).filter(F.col("_r") <= top)
        named = best.groupBy("combo").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "partner"))), lambda r: r["partner"].cast("string")), ",").alias("partners"))
        out = out.join(named, "combo", "left")
    return out


def match_open(legs: Mapping[str, DataFrame], entity: str, award: str, n: int) -> DataFrame:
    """Awards that match an entity by any leg; strongest leg kept (first named is strongest), top n."""
    parts = [df.select(entity, award).withColumn("strength", F.lit(i)).withColumn("edge", F.lit(name)) for i, (name, df) in enumerate(legs.items(), 1)]
    best = reduce(DataFrame.union, parts).groupBy(entity, award).agg(F.min(F.struct("strength", "edge")).alias("b"))
    w = Window.partitionBy(entity).orderBy("b.strength", award)
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select(entity, award, F.col("b.edge").alias("edge"), "rank")


def overlap(need: Column, supply: Column) -> tuple[Column, Column]:
    """Shared members of two lists in order, and their part of the need."""
    shared = F.array_sort(F.array_intersect(need, supply))
    return shared, F.round(F.size(shared) / F.nullif(F.size(F.array_distinct(need)), F.lit(0)), 6)


def rule_score(rules: Sequence[tuple[Column, int]]) -> Column:
    """Sum of the points of rules that hold."""
    return reduce(lambda a, b: a + b, [F.when(c, p).otherwise(0) for c, p in rules])


def cohort(universe: DataFrame, key: str, where: Column, done: DataFrame) -> DataFrame:
    """Distinct keys that pass and aren't done."""
    return universe.filter(where).select(key).distinct().join(done, key, "left_anti")


def slice_pack(df: DataFrame, where: Column, dims: Sequence[str], measure: str) -> DataFrame:
    """dim, value, n, total, share, median for several dimensions of one filtered universe."""
    rows = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])
    grouped = df.filter(where).select(measure, F.inline(rows)).groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"), F.sum(measure).alias("t"), F.percentile(measure, 0.5).alias("median"))
    return grouped.select("dim", "value", "n", F.round("t", 2).alias("total"), F.round(F.col("t") / F.sum("t").over(Window.partitionBy("dim")), 6).alias("share"), F.round("median", 4).alias("median"))


def stratified(df: DataFrame, stratum: Column, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum by seeded hash order."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(key)))
    w = Window.partitionBy("stratum").orderBy(order, key)
    return df.withColumn("stratum", stratum).withColumn("pick", F.row_number().over(w)).filter(F.col("pick") <= n)


def shard(df: DataFrame, key: str, n: int) -> DataFrame:
    """Disjoint shards by key hash."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.withColumn("shard", h % n)


def apply_corrections(df: DataFrame, key: str, ledger: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Facts with the latest assertion of each field over them; an assertion of null sets null.
    ledger: key, field, value, seq."""
    last = ledger.groupBy(key, "field").agg(F.max_by(F.struct("value"), "seq").alias("said"))
    wide = last.groupBy(key).pivot("field", list(cols)).agg(F.first("said"))
    joined = df.join(wide.select(key, *[F.col(c).alias(f"_{c}") for c in cols]), key, "left")
    now = lambda c: F.when(F.col(f"_{c}").isNull(), F.col(c)).otherwise(F.col(f"_{c}.value").cast(df.schema[c].dataType))
    return joined.select(*[now(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def book(df: DataFrame, party: str, counter: str, code: str, measure: str, top: int, floor: float) -> DataFrame:
    """party, code, counters, total, market: the blended signature of each party (its top codes by counterparties
    and by value) with the parties whose business in the code reaches a floor (X11)."""
    per = df.groupBy(party, code).agg(F.count_distinct(counter).alias("counters"), F.round(F.sum(measure), 2).alias("total"))
    w = Window.partitionBy(party)
    marked = per.withColumn("_a", F.row_number().over(w.orderBy(F.desc("counters"), code))).withColumn("_b", F.row_number().over(w.orderBy(F.desc("total"), code)))
    market = per.filter(F.col("total") >= floor).groupBy(code).agg(F.count(F.lit(1)).alias("market"))
    return marked.filter((F.col("_a") <= top) | (F.col("_b") <= top)).drop("_a", "_b").join(market, code, "left").fillna(0, ["market"])


def book_years(df: DataFrame, party: str, counter: str, role: str, day: str, measure: str) -> DataFrame:
    """party, year, role, n, counters, total: the book by year, split by the party's role (X11)."""
    by = df.groupBy(party, F.year(day).alias("year"), F.col(role).alias("role"))
    return by.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(counter).alias("counters"), F.round(F.sum(measure), 2).alias("total"))
