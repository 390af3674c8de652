"""Filter interaction audit: which filter of a chain does what, in every order of the chain.

Each filter is a relation: one written table with the ids of the rows that fail it, and so are the
labels. Left-semi and left-anti joins take the rows apart relation by relation (those in it, those
not in it), so that after the last one every row stands in the cell of exactly the relations that hold
it; a join moves an id, a part and a number, never a text. The survivors of a prefix are the cells that
no filter of the prefix holds, whatever its order, so the counts of all prefixes are sums over at most
2 ** relations cells a part. ``step`` gives the rows themselves (survivors, removed, redundant) of one
prefix by the same joins, and is what the counts are tested against.

Rows have ids of their own, so a document that occurs several times counts as often. The duplicate
filter compares digests of whole texts: groups are counted before they meet the rows, and the at most
``HOT`` texts that each hold 1/HOT of all rows are broadcast, so that no copied text lands in one task.

Defined results: a null text counts as empty (no words, fails A, is a copy of other empty ones); a
null doc_id is no copy and has no copies, and has no label; of several labels of a doc_id any 1
counts; a null part is the empty string; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut

FEW_WORDS, HOT = 200, 1000
FILTERS = "ABCDE"


def rules(text: Column) -> dict[str, Column]:
    """The filters that one text decides: too few words, few different words, capitals, marks."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < FEW_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def facts(docs: DataFrame, by_text: Mapping[str, Column], text: Column, part: Column) -> DataFrame:
    """row, doc_id, part, digest and one boolean for each rule, written once: no text is read again."""
    flags = [F.coalesce(c, F.lit(False)).alias(k) for k, c in by_text.items()]
    row = F.monotonically_increasing_id().alias("row")  # stays as it is, since the table is written
    return cut(docs.select(row, F.col("doc_id"), part.alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *flags))


def copies(facts_: DataFrame) -> DataFrame:
    """Rows whose text a smaller doc_id has."""
    groups = facts_.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).filter("n > 1")
    groups = cut(groups)
    many = F.col("n") >= max(2, facts_.count() / HOT)  # so many groups there can be at most HOT of
    rows = facts_.select("row", "doc_id", "digest")
    hot, rest = F.broadcast(groups.filter(many).select("digest", "first")), groups.filter(~many).select("digest", "first")
    met = rows.join(hot, "digest").unionByName(rows.join(hot.select("digest"), "digest", "left_anti").join(rest, "digest"))
    return met.filter(F.col("doc_id") > F.col("first")).select("row")


def relations(facts_: DataFrame, labels: DataFrame, by_text: Sequence[str]) -> dict[str, DataFrame]:
    """One written id table for each filter and each label."""
    out = {k: cut(facts_.filter(F.col(k)).select("row")) for k in by_text}
    out["E"] = cut(copies(facts_))
    for name, mark in (("good", F.col("quality") == 1), ("toxic", F.col("toxic") == 1)):
        marked = labels.filter(mark).select("doc_id").distinct()
        out[name] = cut(facts_.select("row", "doc_id").join(marked, "doc_id", "left_semi").select("row"))
    return out


def cells(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """rows (row, part) with ``held``, a number whose bit i tells that relation i holds the row."""
    out = rows.select("row", "part", F.lit(0).alias("held"))
    for i, ids in enumerate(tables.values()):
        within = out.join(ids, "row", "left_semi").withColumn("held", F.col("held") + (1 << i))
        out = cut(within.unionByName(out.join(ids, "row", "left_anti")))
    return out


def step(rows: DataFrame, tables: Mapping[str, DataFrame], before: Sequence[str], name: str) -> dict[str, DataFrame]:
    """Rows of one step of a chain: kept by the prefix and by ``name``, removed here, failing but removed before."""
    alive = rows
    for other in before:
        alive = alive.join(tables[other], "row", "left_anti")
    failing = rows.join(tables[name], "row", "left_semi")
    return {
        "kept": alive.join(tables[name], "row", "left_anti"),
        "removed": alive.join(tables[name], "row", "left_semi"),
        "redundant": failing.join(alive.select("row"), "row", "left_anti"),
    }


def audit(cells_: DataFrame, filters: str = FILTERS, labels: Sequence[str] = ("good", "toxic")) -> DataFrame:
    """part, filter_order, step and the counts of each prefix of each order, from the cells of ``cells``."""
    per_part = cells_.groupBy("part", "held").agg(F.count(F.lit(1)).alias("n")).groupBy("part").agg(F.collect_list(F.struct("held", "n")).alias("cells"))
    orders = ["".join(p) for p in permutations(filters)]
    bit = F.pow(F.lit(2), F.instr(F.lit(filters), F.col("letter")) - 1).cast("int")
    mask = lambda letters: F.aggregate(F.split(letters, ""), F.lit(0), lambda a, c: a + F.pow(F.lit(2), F.instr(F.lit(filters), c) - 1).cast("int"))
    steps = (
        per_part.select("part", "cells", F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
        .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumns({"own": bit, "before": F.when(F.col("step") == 1, 0).otherwise(mask(F.substring("filter_order", F.lit(1), F.col("step") - 1)))})
    )
    every = (1 << len(filters)) - 1
    total = lambda keep, weight=None: F.aggregate(
        F.filter("cells", keep), F.lit(0).cast("long"), lambda a, c: a + (c["n"] if weight is None else c["n"] * weight(c))
    )
    fails = lambda c: c["held"].bitwiseAND(F.col("own")) > 0
    gone = lambda c: c["held"].bitwiseAND(F.col("before")) > 0
    here = lambda c: fails(c) & ~gone(c)
    lost = lambda i: total(lambda c: here(c) & (c["held"].bitwiseAND(F.lit(1 << (len(filters) + i))) > 0))
    # of all orders, those that have this filter before the k - 1 others that a row fails are one in k
    each = lambda c: (F.lit(len(orders)) / F.bit_count(c["held"].bitwiseAND(F.lit(every)))).cast("long")
    return steps.select(
        "part", "filter_order", "step",
        total(lambda c: ~fails(c) & ~gone(c)).alias("kept"),
        total(here).alias("removed"),
        total(lambda c: fails(c) & gone(c)).alias("redundant"),
        total(lambda c: c["held"].bitwiseAND(F.lit(every)) == F.col("own")).alias("unique_fails"),
        *[lost(i).alias(f"{name}_lost") for i, name in enumerate(labels)],
        total(fails, each).alias("shapley"),
    )


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered digest over ``documents`` and ``labels``, parts by source."""
    text = F.coalesce(F.col("text"), F.lit(""))
    by_text = rules(text)
    known = facts(docs.select("doc_id", "text", "source"), by_text, text, F.coalesce(F.col("source").cast("string"), F.lit("")))
    return audit(cells(known, relations(known, labels, list(by_text))))


#: The same by DuckDB, from the failing flags of each document.
SQL = """
with d as (select doc_id, coalesce(text, '') as t, coalesce(source, '') as part from documents),
w as (select *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws, min(doc_id) over (partition by t) as first from d),
l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by 1),
f as (select part, coalesce(quality, 0) = 1 as good, coalesce(toxic, 0) = 1 as toxic,
    case when len(ws) < 200 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end || case when doc_id > first then 'E' else '' end as fails
    from w left join l using (doc_id)),
c as (select part, fails, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from f group by 1, 2),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as k),
o as (select a.k || b.k || c.k || d.k || e.k as filter_order from x a, x b, x c, x d, x e where a.k <> b.k and c.k not in (a.k, b.k) and d.k not in (a.k, b.k, c.k) and e.k not in (a.k, b.k, c.k, d.k)),
s as (select filter_order, step, filter_order[step] as k, filter_order[1:step - 1] as before from o, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (select part, filter_order, step, k, n, good, toxic, contains(fails, k) as own, fails = k as alone, step > 1 and translate(fails, before, '') <> fails as gone from s, c),
g as (select part, filter_order, step, any_value(k) as k, coalesce(sum(n) filter (where not own and not gone), 0)::bigint as kept, coalesce(sum(n) filter (where own and not gone), 0)::bigint as removed,
    coalesce(sum(n) filter (where own and gone), 0)::bigint as redundant, coalesce(sum(n) filter (where alone), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (where own and not gone), 0)::bigint as good_lost, coalesce(sum(toxic) filter (where own and not gone), 0)::bigint as toxic_lost from r group by 1, 2, 3)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, k)::bigint as shapley from g
"""
