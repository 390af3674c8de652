"""Projections: column specs, star edits, unpivots, explodes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, spec: Sequence[tuple[str, str, Mapping[str, str]]], side: str) -> DataFrame:
    """Columns of a spec (name, type, expression by side) in its order; typed null where a side has none."""
    return df.select(*[F.expr(by[side]).cast(kind).alias(name) if side in by else F.lit(None).cast(kind).alias(name) for name, kind, by in spec])


def select_star(df: DataFrame, exclude: Sequence[str] = (), replace: Mapping[str, Column] | None = None, rename: Mapping[str, str] | None = None) -> DataFrame:
    """All columns but some, some replaced, some renamed."""
    return df.withColumns(dict(replace or {})).drop(*exclude).withColumnsRenamed(dict(rename or {}))


def decode(df: DataFrame, col: str, vocab: DataFrame, code: str, name: str) -> DataFrame:
    """Name of a code from a vocabulary, null where it lacks the code."""
    return df.join(vocab.select(F.col(code).alias(col), name), col, "left")


def unpivot_blocks(df: DataFrame, ids: Sequence[str], blocks: Sequence[Mapping[str, str]]) -> DataFrame:
    """A row for each block of columns that isn't all null, with its slot from 1 (P10)."""
    rows = F.array(*[F.struct(F.lit(i).alias("slot"), *[F.col(c).alias(n) for n, c in b.items()]) for i, b in enumerate(blocks, 1)])
    out = df.select(*ids, F.inline(rows))
    return out.filter(F.coalesce(*[F.col(n).cast("string") for n in blocks[0]]).isNotNull())


def explode_fields(df: DataFrame, ids: Sequence[str], fields: Mapping[str, Column]) -> DataFrame:
    """(field, code) rows of several columns in one scan, nulls dropped."""
    rows = F.array(*[F.struct(F.lit(n).alias("field"), c.cast("string").alias("code")) for n, c in fields.items()])
    return df.select(*ids, F.inline(rows)).filter("code is not null")


def union_tagged(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Union by name with the part's name as ``source``; absent columns null."""
    out = None
    for name, df in parts.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def key_universe(*parts: DataFrame) -> DataFrame:
    """Distinct keys of all parts."""
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def set_delta(df: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """key, change, member: what two set columns gained and lost."""
    side = lambda a, b, tag: df.select(key, F.lit(tag).alias("change"), F.explode(F.array_except(a, b)).alias("member"))
    return side(new, old, "added").union(side(old, new, "removed"))
