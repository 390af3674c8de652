"""Typing and cleaning of single values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_cast(col: Column, kind: str) -> Column:
    """Value of the type, null where it can't be."""
    return col.try_cast(kind)


def parse_date(col: Column, formats: Sequence[str]) -> Column:
    """Date by the first format that fits the trimmed text."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(col), F.lit(f)) for f in formats]).cast("date")


def parse_money(col: Column, precision: int = 18, scale: int = 2) -> Column:
    """Number in text with currency, group and percent marks; (x) is negative."""
    bare = F.regexp_replace(F.trim(col), r"[$,%\s()]", "")
    signed = F.when(F.trim(col).rlike(r"^\(.*\)$"), F.concat(F.lit("-"), bare)).otherwise(bare)
    return signed.try_cast(f"decimal({precision},{scale})")


def clamp(col: Column, lo, hi) -> Column:
    """Value between the bounds, else null."""
    return F.when(col.between(lo, hi), col)


def classify(col: Column, classes: Mapping[str, Sequence], default: str | None = None) -> Column:
    """Class whose list holds the value."""
    out = None
    for name, values in classes.items():
        out = F.when(col.isin(list(values)), name) if out is None else out.when(col.isin(list(values)), name)
    return out.otherwise(F.lit(default))


def parse_list(col: Column, separator: str, strip: str | None = None) -> Column:
    """Trimmed, non-empty members of a list in text; ``strip`` is a pattern removed from each."""
    member = (lambda x: F.regexp_replace(F.trim(x), strip, "")) if strip else lambda x: F.trim(x)  # one parameter: two would get the index
    return F.filter(F.transform(F.split(col, separator), member), lambda x: x != "")


def surrogate(*cols: Column, bits: int = 256) -> Column:
    """Hash over columns, null and empty told apart."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols])
    return F.md5(text) if bits == 128 else F.sha2(text, bits)


def concat_key(*parts: Column, separator: str = "-") -> Column:
    """Natural key of its parts, null if one is null."""
    out = []
    for i, p in enumerate(parts):
        out += ([F.lit(separator)] if i else []) + [p.cast("string")]
    return F.concat(*out)


def first_present(**cols: Column) -> Column:
    """struct<value, source>: first column that isn't null, and its name."""
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in cols.items()])
    return F.struct(F.coalesce(*cols.values()).alias("value"), source.alias("source"))


def fiscal_year(day: Column) -> Column:
    """Fiscal year that begins in October."""
    return F.year(F.add_months(day.cast("date"), 3))


def json_get(col: Column, path: str, kind: str = "string") -> Column:
    """Typed value at a JSON path, null where it is absent or of another type."""
    return F.get_json_object(col, path).try_cast(kind)


def share(part: Column, whole: Column) -> Column:
    """Quotient, null for a zero or null divisor."""
    return part / F.nullif(whole, F.lit(0))


def code_match(col: Column, exact: Sequence[str] = (), prefixes: Sequence[str] = ()) -> Column:
    """Code in a list, or with one of the prefixes; false if both are empty."""
    out = col.isin(list(exact)) if exact else F.lit(False)
    for p in prefixes:
        out = out | col.startswith(p)
    return out


def band(col: Column, lo=None, hi=None) -> Column:
    """Within bounds, of which either may be open."""
    out = F.lit(True)
    if lo is not None:
        out = out & (col >= lo)
    if hi is not None:
        out = out & (col <= hi)
    return out


def within(col: Column, as_of: str, months_back: int | None = None, days_ahead: int | None = None) -> Column:
    """In the months up to a day, or the days from it on."""
    day, at = F.to_date(F.lit(as_of)), col.cast("date")
    if months_back is not None:
        return (at > F.add_months(day, -months_back)) & (at <= day)
    return (at >= day) & (at <= F.date_add(day, days_ahead))


def redact(mark: Column, *names: str) -> list[Column]:
    """Columns nulled on marked rows."""
    return [F.when(~F.coalesce(mark, F.lit(False)), F.col(n)).alias(n) for n in names]


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of a pattern's leftmost matches that don't overlap; code points
    from 0, end exclusive. A null text has none."""
    body = F.coalesce(text, F.lit(""))
    met = F.zip_with(F.split(body, pattern, -1), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("value")))
    met = F.filter(met, lambda m: m["value"].isNotNull())  # the last gap has no match after it
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        end = start + F.length(m["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value")))).alias("out"))

    return F.aggregate(met, zero, step, lambda acc: acc["out"])
