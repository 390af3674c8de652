"""Reconciliation and history jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.values import parse_list
from recordloom.operators.joins import small
from recordloom.operators.project import project, set_delta, union_tagged
from recordloom.operators.windows import changed_fields, ladder_delta, latest_per_key, scd2, tenure


def canonicalise(feeds: Mapping[str, DataFrame], spec: Sequence, key: str, ts: str, order: Sequence[str]) -> DataFrame:
    """One row per key over several feeds.

    Each feed is projected by the spec and collapsed to its latest row; the row modified last wins,
    the feed named first on ties; ``source`` tells the winner and ``n_sources`` how many had the key.
    """
    rank = {n: i for i, n in enumerate(feeds)}
    parts = {n: latest_per_key(project(df, spec, n), [key], [F.col(ts).desc_nulls_last(), *[F.col(c) for c in order]]) for n, df in feeds.items()}
    tagged = union_tagged(parts)
    place = F.lit(len(rank))
    for n, i in rank.items():
        place = F.when(F.col("source") == n, i).otherwise(place)
    w = Window.partitionBy(key)
    won = tagged.withColumn("n_sources", F.count(F.lit(1)).over(w)).withColumn("_rn", F.row_number().over(w.orderBy(F.col(ts).desc_nulls_last(), place)))
    return won.filter("_rn = 1").select(*[n for n, _, _ in spec], "source", "n_sources")


def merge_delta(bulk: DataFrame, delta: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """bulk with the rows of delta that are at least as recent; rows without a key stay."""
    keyed = union_tagged({"delta": delta, "bulk": bulk})
    winner = latest_per_key(keyed.filter(F.col(key).isNotNull()), [key], [F.col(ts).desc_nulls_last(), F.desc("source"), F.col(tie)])
    return winner.unionByName(keyed.filter(F.col(key).isNull()))


def award_state(lines: DataFrame, key: str, order: Sequence[str], amount: str, end: str, ceiling: DataFrame, as_of: str) -> DataFrame:
    """State of each award from its ladder: totals, last action, part of the ceiling used, days left.

    ceiling: key, ceiling.
    """
    last = lines.groupBy(key).agg(F.max(F.struct(*order)).alias("_l"), F.round(F.sum(amount), 2).alias("obligated"), F.count(F.lit(1)).alias("n_actions"), F.max(F.col(end).cast("date")).alias("end_day"))
    out = last.join(ceiling, key, "left")
    left = F.datediff("end_day", F.to_date(F.lit(as_of)))
    return out.select(
        key, "obligated", "n_actions", "end_day", "ceiling",
        F.round(F.col("obligated") / F.nullif("ceiling", F.lit(0.0)), 6).alias("consumed"),
        F.round(F.col("ceiling") - F.col("obligated"), 2).alias("headroom"),
        left.alias("days_left"), (left >= 0).alias("is_active"),
    )


def mod_delta(ladder: DataFrame, key: str, order: Sequence[str], amount: str, cols: Sequence[str]) -> DataFrame:
    """Differences and moved columns of each action, with its class."""
    out = changed_fields(ladder_delta(ladder, key, order, [amount]), key, order, cols)
    d = F.col(f"d_{amount}")
    kind = F.when(d.isNull(), "first").when(d > 0, "increase").when(d < 0, "decrease").when(F.col("changed") != "", "change").otherwise("none")
    return out.withColumn("action_class", kind)


def entity_versions(txns: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], valid: str) -> DataFrame:
    """Version history with a fingerprint per version."""
    out = scd2(txns, key, order, cols, valid)
    return out.withColumn("version_key", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("version").cast("string"), *[F.col(c).cast("string") for c in cols])))


def profile_deltas(snapshots: DataFrame, key: str, label: str, scalars: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """key, label, field, change, old, new between a key's consecutive snapshots."""
    labels = snapshots.select(label).distinct().withColumn("_r", F.dense_rank().over(Window.orderBy(label)))
    ranked = snapshots.join(small(labels), label)
    before = ranked.select(key, (F.col("_r") + 1).alias("_r"), *[F.col(c).alias(f"_{c}") for c in [*scalars, *sets]])
    both = ranked.join(before, [key, "_r"])
    parts = [both.filter(~F.col(c).eqNullSafe(F.col(f"_{c}"))).select(key, label, F.lit(c).alias("field"), F.lit("changed").alias("change"), F.col(f"_{c}").cast("string").alias("old"), F.col(c).cast("string").alias("new")) for c in scalars]
    for c in sets:
        moved = set_delta(both.select(F.struct(key, label).alias("k"), F.col(f"_{c}").alias("o"), F.col(c).alias("n")), "k", "o", "n")
        parts.append(moved.select(f"k.{key}", f"k.{label}", F.lit(c).alias("field"), "change", F.when(F.col("change") == "removed", F.col("member")).alias("old"), F.when(F.col("change") == "added", F.col("member")).alias("new")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def signal_events(txns: DataFrame, key: str, day: Column, order: Sequence[str], code: str, role: str) -> DataFrame:
    """key, day, signal, value: first seen, code added, role changed."""
    dated = txns.withColumn("day", day)
    first = dated.groupBy(key).agg(F.min("day").alias("day"))
    codes = dated.groupBy(key, code).agg(F.min("day").alias("day")).join(first.withColumnRenamed("day", "_f"), key).filter("day > _f")
    w = Window.partitionBy(key).orderBy(*order)
    roles = dated.withColumn("_p", F.lag(role).over(w)).filter(F.col("_p").isNotNull() & (F.col("_p") != F.col(role)))
    out = first.select(key, "day", F.lit("first_seen").alias("signal"), F.lit(None).cast("string").alias("value"))
    out = out.union(codes.select(key, "day", F.lit("code_added"), F.col(code).cast("string")))
    return out.union(roles.select(key, "day", F.lit("role_changed"), F.concat_ws(">", "_p", role))).distinct()


def entity_master(snapshots: DataFrame, key: str, label: str, active: Column, cols: Sequence[str], lists: Mapping[str, str] | None = None) -> DataFrame:
    """Latest row of each entity with its tenure over the snapshots; columns of lists (name: separator)
    become arrays of their members (R08)."""
    last = latest_per_key(snapshots, [key], [F.desc(label), *[F.col(c) for c in cols]]).select(key, *cols)
    parsed = last.withColumns({c: parse_list(F.col(c), separator) for c, separator in (lists or {}).items()})
    return parsed.join(tenure(snapshots, key, label, active), key)


def satellites(master: DataFrame, key: str, col: str) -> DataFrame:
    """key, position, value: the members of a master's array column."""
    return master.select(key, F.posexplode(col).alias("position", "value"))


def normalise_registries(parts: Mapping[str, DataFrame], spec: Sequence, name: str, key_fn, base_fn) -> DataFrame:
    """Registries of several layouts in one shape with minted keys."""
    out = union_tagged({n: project(df, spec, n) for n, df in parts.items()})
    keyed = out.withColumn("name_key", key_fn(F.col(name))).withColumn("name_base", base_fn(F.col("name_key")))
    return keyed.withColumn("registry_key", F.md5(F.concat_ws("|", "source", F.col("id").cast("string"))))
