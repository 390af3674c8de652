"""The predicate layer: filter objects, entity sets, collapses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.values import band, within


def compile_filters(filters: Sequence[Mapping], registry: Mapping[str, tuple[str, str]]) -> Column:
    """Conjunction of filter objects over a closed registry field -> (column, type).

    Objects have field, op (eq, in, range, prefix, contains, is, last_months) and value; anything
    outside the registry or the operations raises ValueError.
    """
    out = F.lit(True)
    for f in filters:
        if f["field"] not in registry:
            raise ValueError(f"unknown field {f['field']}")
        name, kind = registry[f["field"]]
        col, op, value = F.col(name), f["op"], f["value"]
        allowed = {"string": ("eq", "in", "prefix", "contains"), "number": ("eq", "in", "range"), "date": ("range", "last_months"), "bool": ("is",)}
        if op not in allowed[kind]:
            raise ValueError(f"{op} is no operation of {kind} field {f['field']}")
        if op == "eq":
            one = col == value
        elif op == "in":
            one = col.isin(list(value))
        elif op == "range":
            lo, hi = value
            one = band(col.cast("date"), lo and F.to_date(F.lit(lo)), hi and F.to_date(F.lit(hi))) if kind == "date" else band(col, lo, hi)
        elif op == "prefix":
            one = col.startswith(value)
        elif op == "contains":
            one = F.lower(col).contains(value.lower())
        elif op == "is":
            one = col == F.lit(bool(value))
        else:
            one = within(col, value["as_of"], months_back=value["months"])
        out = out & one
    return out


def having_band(df: DataFrame, key: str, measure: str, lo: float | None, hi: float | None, where: Column | None = None) -> DataFrame:
    """Keys whose sum over the filtered rows lies in a band."""
    own = df.filter(where) if where is not None else df
    return own.groupBy(key).agg(F.sum(measure).alias("total")).filter(band(F.col("total"), lo, hi))


def entities_where(universe: DataFrame, key: str, include: Sequence[DataFrame] = (), exclude: Sequence[DataFrame] = ()) -> DataFrame:
    """Keys in every included set and in no excluded one; of the universe if nothing is included."""
    out = (include[0] if include else universe).select(key).distinct()
    for leg in include[1:]:
        out = out.join(leg, key, "left_semi")
    for leg in exclude:
        out = out.join(leg, key, "left_anti")
    return out


def collapse_then_filter(facts: DataFrame, key: str, fact_where: Column, entities: DataFrame, entity_where: Column) -> DataFrame:
    """Entities that pass a filter and have a fact that passes another."""
    return entities.filter(entity_where).join(facts.filter(fact_where).select(key), key, "left_semi")


def lookup(df: DataFrame, key: str, ids: Sequence) -> DataFrame:
    """Rows of an id list in its order; ``found`` tells misses."""
    kind = df.schema[key].dataType.simpleString()
    wanted = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(ids)], f"position int, {key} {kind}")
    hit = df.join(F.broadcast(wanted.select(key).distinct()), key, "left_semi").withColumn("found", F.lit(True))  # the list is the call's own
    return wanted.join(hit, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def hydrate(keys: DataFrame, key: str, *marts: DataFrame) -> DataFrame:
    """Columns of several marts beside each key."""
    for m in marts:
        keys = keys.join(m, key, "left")
    return keys


def code_search(vocab: DataFrame, code: str, name: str, text: str) -> DataFrame:
    """Codes whose code or name holds the text, with the most frequent name of each."""
    hit = vocab.filter(F.lower(code).contains(text.lower()) | F.lower(name).contains(text.lower()))
    counted = hit.groupBy(code, name).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(code).agg(F.min(F.struct(-F.col("n"), F.col(name).alias("name"))).alias("b"), F.sum("n").alias("n")).select(code, F.col("b.name").alias("name"), "n")


def satisfies_all(df: DataFrame, key: str, legs: Sequence[Column]) -> DataFrame:
    """Rows that satisfy some leg, of keys that satisfy all of them; ``leg`` numbers the first from 0."""
    marks = F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(legs)])
    evidence = df.withColumn("leg", F.explode(F.filter(marks, lambda x: x.isNotNull())))
    full = evidence.groupBy(key).agg(F.count_distinct("leg").alias("n")).filter(F.col("n") == len(legs))
    return evidence.join(full, key, "left_semi")
