"""Profile, rollup and matching jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators.aggregates import growth, merge_rollups, nest, trajectory_map


def gold_profile(spine: DataFrame, key: str, contacts: DataFrame, money: DataFrame) -> DataFrame:
    """Spine with ordered nested contacts and a financial résumé, zero where absent."""
    out = spine.join(contacts, key, "left").join(money, key, "left")
    return out.fillna(0, [c for c in money.columns if c != key])


def entity_summary(awards: DataFrame, subs: DataFrame, key: str, measure: str, partner: str, n: int = 3) -> DataFrame:
    """Totals on both sides of each entity with its largest partners (R10). The lists are the report's top n."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        per = df.groupBy(key, partner).agg(F.sum(measure).alias("v"), F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy(key).orderBy(F.desc("v"), partner)
        ranked = per.withColumn("rn", F.row_number().over(w))
        top = F.array_sort(F.collect_list(F.when(F.col("rn") <= n, F.struct("rn", F.col(partner).cast("string").alias("p")))))
        return ranked.groupBy(key).agg(F.round(F.sum("v"), 2).alias(f"{tag}_total"), F.sum("c").alias(f"{tag}_n"), F.array_join(F.transform(top, lambda r: r["p"]), ",").alias(f"{tag}_top"))

    both = side(awards, "award").join(side(subs, "sub"), key, "full")
    return both.fillna(0, ["award_total", "award_n", "sub_total", "sub_n"]).fillna("", ["award_top", "sub_top"])


def people(evidence: DataFrame, org: str, name_key: str, title: str, priority: str) -> DataFrame:
    """Evidence rows collapsed to people: key by hash, best title, sources, mentions."""
    keyed = evidence.filter(F.col(name_key).isNotNull()).withColumn("person_id", F.md5(F.concat_ws("|", F.col(org).cast("string"), name_key)))
    best = F.min(F.when(F.col(title).isNotNull(), F.struct(priority, title)))
    return keyed.groupBy("person_id", org, name_key).agg(best[title].alias(title), F.array_join(F.array_sort(F.collect_set("source")), "+").alias("sources"), F.count(F.lit(1)).alias("mentions"))


def satellites(wide: DataFrame, key: str, families: Mapping[str, Sequence[str]]) -> DataFrame:
    """key, family, slot, value of slot columns."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(i).alias("slot"), F.col(c).cast("string").alias("value")) for f, cols in families.items() for i, c in enumerate(cols, 1)]
    return wide.select(key, F.inline(F.array(*rows))).filter("value is not null")


def profile_360(facts: DataFrame, key: str, year: str, measure: str) -> DataFrame:
    """Latest year, lifetime sum, growth, year map and flags of each key."""
    per = facts.groupBy(key, year).agg(F.sum(measure).alias("_v"))
    base = per.groupBy(key).agg(F.max(year).alias("latest_year"), F.round(F.max_by("_v", year), 2).alias("latest"), F.round(F.sum("_v"), 2).alias("lifetime"), F.count(F.lit(1)).alias("active_years"))
    out = base.join(growth(facts, key, year, measure).select(key, "yoy"), key).join(trajectory_map(facts, key, year, measure), key)
    return out.withColumn("is_growing", F.coalesce(F.col("yoy") > 0, F.lit(False)))


def facility_360(spine: DataFrame, key: str, programs: Mapping[str, DataFrame]) -> DataFrame:
    """Spine beside a count for each program, with the number of programs."""
    rolled = [df.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{n}")) for n, df in programs.items()]
    out = spine.join(merge_rollups(key, *rolled), key, "left").fillna(0, subset=[f"n_{n}" for n in programs])
    return out.withColumn("n_programs", sum(((F.col(f"n_{n}") > 0).cast("int") for n in programs), F.lit(0)))


def award_book(state: DataFrame, key: str, value: str, kind: str) -> DataFrame:
    """Size, median and mix of each entity's book."""
    return state.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 2).alias("total"), F.round(F.percentile(value, 0.5), 4).alias("median"), F.count_distinct(kind).alias("kinds"))


def pricing_flow(txns: DataFrame, key: str, day: str, value: str, kind: str, as_of: str) -> DataFrame:
    """Sum of the last year and the year before for each entity and kind."""
    at, end = F.col(day).cast("date"), F.to_date(F.lit(as_of))
    recent = (at > F.add_months(end, -12)) & (at <= end)
    prior = (at > F.add_months(end, -24)) & (at <= F.add_months(end, -12))
    part = lambda c: F.round(F.sum(F.when(c, F.col(value)).otherwise(0)), 2)
    return txns.filter(recent | prior).groupBy(key, kind).agg(part(recent).alias("recent"), part(prior).alias("prior"))


def align_rates(rates: DataFrame, area: str, regime: str, value: str, regimes: Sequence[str]) -> DataFrame:
    """Median rate of each regime by area, with the spread between the extremes."""
    wide = rates.groupBy(area).pivot(regime, list(regimes)).agg(F.round(F.percentile(value, 0.5), 4))
    return wide.withColumn("spread", F.round(F.greatest(*regimes) - F.least(*regimes), 4))


def combo_dim(parts: DataFrame, combo: Sequence[str], category: str, value: str) -> DataFrame:
    """One row per combo with its priced categories nested in order."""
    priced = parts.groupBy(*combo, category).agg(F.round(F.avg(value), 4).alias("price"), F.count(F.lit(1)).alias("n"))
    return priced.groupBy(*combo).agg(F.array_sort(F.collect_list(F.struct(category, "price", "n"))).alias("categories"))


def rates_for(nested: DataFrame, spine: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Nested rate rows of a target id set, beside the spine's columns (R19). nested: key, items array."""
    own = nested.join(targets.select(key).distinct(), key, "left_semi")
    return own.select(key, F.inline("items")).join(spine, key)


def corroborate(items: DataFrame, texts: DataFrame, key: str, phrase: str, text: str) -> DataFrame:
    """Items whose phrase occurs in the key's own text, with its first place."""
    met = items.join(texts.select(key, F.col(text).alias("_t")), key)
    at = F.expr(f"locate(lower({phrase}), lower(_t))")
    return met.withColumn("at", at).filter("at > 0").drop("_t")


def partner_signals(edges: DataFrame, events: DataFrame, parent: str, partner: str, since: str, kind: Column) -> DataFrame:
    """Parent events since a day for each partner: count, last day, last of a class, after the last own activity.

    edges: parent, partner, last_active; events: parent, day.
    """
    met = edges.join(events.filter(F.col("day") >= F.to_date(F.lit(since))), parent)
    return met.groupBy(partner).agg(F.count(F.lit(1)).alias("n_events"), F.max("day").alias("last_event"), F.max(F.when(kind, F.col("day"))).alias("last_of_class"), F.bool_or(F.col("day") > F.col("last_active")).alias("after_last_activity"))


def assemble(spine: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Records with an ordered array for each child file: name -> (rows, order, fields)."""
    for name, (df, order, fields) in children.items():
        spine = spine.join(nest(df, key, order, fields, name), key, "left")
    return spine
