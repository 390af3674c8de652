"""Scans. Schemas are given, never inferred; landing types are strings."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.keys import blank_null
from recordloom.sources.scratch import written


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", header: bool = True) -> DataFrame:
    """All columns as strings; quoting and gzip as Spark's reader has them."""
    return spark.read.csv(path, schema=strings(columns), sep=sep, header=header, quote='"', escape='"', mode="PERMISSIVE")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """value, file, place: lines of files, in order by the block they are in, then as a task reads them."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"))


QUOTED = '"(?:[^"]|"")*"'


def read_ragged(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", header: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows, short ones padded with nulls, and the raw lines that have too many fields or an unbalanced
    quote (S02). header: each file's first line is left out; a quoted field holds no line break."""
    lines = _placed(spark, path)
    if header:
        firsts = lines.groupBy("file").agg(F.min("place").alias("first"))  # a row a file
        lines = lines.join(firsts, "file").filter(F.col("place") > F.col("first"))
    bare = F.regexp_replace("value", QUOTED, "")
    fits = (F.size(F.split(bare, f"\\Q{sep}\\E", -1)) <= len(columns)) & ~F.contains(bare, F.lit('"'))
    row = F.from_csv("value", ", ".join(f"`{c}` string" for c in columns), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return lines.filter(fits & (F.col("value") != "")).select(row.alias("r")).select("r.*"), lines.filter(~fits).select(F.col("value").alias("line"))


def read_fixed_width(spark: SparkSession, path: str, layout: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Columns by (first position from 1, width), trimmed, blank as null."""
    return spark.read.text(path).select(*[blank_null(F.substring("value", a, n)).alias(c) for c, (a, n) in layout.items()])


def split_positional(df: DataFrame, col: str, sep: str, families: Mapping[int, Mapping[str, int]]) -> DataFrame:
    """Fields by index of a delimited record; its width decides which indices."""
    parts = F.split(F.col(col), sep, -1)
    names = list(dict.fromkeys(n for f in families.values() for n in f))

    def field(name: str) -> Column:
        out = F.lit(None).cast("string")
        for width, places in families.items():
            if name in places:
                out = F.when(F.size(parts) == width, blank_null(F.get(parts, F.lit(places[name])))).otherwise(out)
        return out.alias(name)

    return df.select(F.size(parts).alias("width"), *[field(n) for n in names])


#: Escapes of the dump format beside ``\\N``.
ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", "v": "\v"}


def read_copy_text(spark: SparkSession, path: str, schema: str) -> DataFrame:
    r"""Tab-separated dump text: ``\N`` is null, backslash escapes are decoded, and a file ends at its
    first line ``\.`` (S05)."""
    raw = T.StructType.fromDDL(schema)
    lines = _placed(spark, path)
    ends = lines.filter(F.col("value") == "\\.").groupBy("file").agg(F.min("place").alias("end"))
    body = lines.join(ends, "file", "left").filter(F.col("end").isNull() | (F.col("place") < F.col("end")))

    def field(number: int) -> Column:
        text = F.get(F.split("value", "\t", -1), F.lit(number))
        plain = F.replace(text, F.lit("\\\\"), F.lit("\ue000"))
        for letter, meant in ESCAPES.items():
            plain = F.replace(plain, F.lit("\\" + letter), F.lit(meant))
        return F.when(text != "\\N", F.replace(plain, F.lit("\ue000"), F.lit("\\")))

    return body.select(*[field(i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(raw)])


def read_parquet(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame:
    """Parquet by paths or globs; base keeps partition columns."""
    reader = spark.read.option("basePath", base) if base else spark.read
    return reader.parquet(*paths)


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; a string column keeps a nested value as JSON."""
    return spark.read.json(path, schema=schema)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """One row per element."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def read_nested(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files of one document each; a document is one row and one task's work, however large."""
    return spark.read.json(path, schema=schema, multiLine=True)


# A huge document is read by byte ranges. Its text is cut at closing braces, wherever they stand, so that Spark
# can split the file; what a range does to the state of a reader is found for both cases of its begin
# (within a string or not), the few numbers of each range are composed in order, and then every range is
# read again with its true begin.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+(?:"|\Z)|[{}\[\]]', re.S)
REST = re.compile(r'(?:[^"\\]|\\.)*+"', re.S)
KEY = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', re.S)


def _tokens(text: str, within: bool) -> Iterator[tuple[int, str]]:
    """(place, bracket) outside strings; lastly (-1, "" or a quote) as the text ends outside or within one."""
    at = 0
    if within:
        rest = REST.match(text)
        if not rest:
            yield -1, '"'
            return
        at = rest.end()
    for m in TOKEN.finditer(text, at):
        if m[0][0] != '"':
            yield m.start(), m[0]
        elif m.end() == len(text) and (len(m[0]) == 1 or not REST.fullmatch(text, m.start() + 1)):
            yield -1, '"'
            return
    yield -1, ""


def _label(text: str, at: int, floor: int) -> str | None:
    """The key before a bracket; None in arrays."""
    near = text[max(floor, at - 300) : at]
    found = KEY.search(near) or (KEY.search(text[floor:at]) if near.rstrip().endswith(":") else None)
    return found[1] if found else None


def _ranges(lines: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, str]]:
    """(file, begin of the range, text) of consecutive lines of one range, with the braces they were cut at."""
    for batch in lines:
        if len(batch):
            for _, own in batch.groupby((batch[["file", "start"]] != batch[["file", "start"]].shift()).any(axis=1).cumsum()):
                yield own["file"].iloc[0], int(own["start"].iloc[0]), "}".join(own["value"]) + "}"


def _effects(lines: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each range does: for both begins, whether it ends in a string, brackets closed that it did not
    open, labels of those it leaves open."""
    now, out = None, []

    def shown(key: tuple[str, int], states: list) -> pd.DataFrame:
        return pd.DataFrame({"file": key[0], "start": key[1], "effect": [json.dumps([[w, c, labels] for w, c, labels in states])]})

    for file, start, text in _ranges(lines):
        if now != (file, start):
            if now:
                yield shown(now, out)
            now, out = (file, start), [[False, 0, []], [True, 0, []]]
        for state in out:
            floor = 0
            for at, token in _tokens(text, state[0]):
                if at < 0:
                    state[0] = token == '"'
                elif token in "{[":
                    state[2].append([token, _label(text, at, floor)])
                elif state[2]:
                    state[2].pop()
                else:
                    state[1] += 1
                floor = max(at, floor)
    if now:
        yield shown(now, out)


def _begins(effects: Sequence, target: Sequence) -> dict[tuple[str, int], tuple]:
    """Of each range: whether it begins in a string, the brackets open there, the range in which the element
    that is open there began."""
    out = {}
    for _, own in groupby(sorted(effects, key=lambda r: (r.file, r.start)), key=lambda r: r.file):
        within, stack, origin = False, [], None
        for r in own:
            out[r.file, r.start] = (within, list(stack), origin)
            ends, closed, opened = json.loads(r.effect)[within]
            if len(stack) - closed <= len(target) or origin is None:
                origin = r.start  # no element goes on through the whole range
            within, stack = ends, stack[: max(0, len(stack) - closed)] + opened
    return out


def read_elements(spark: SparkSession, path: str, array: Sequence[str], schema: str, keys: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Objects of the array at a path of keys, of documents of any size (S09): file and the schema's columns.

    Every task reads a byte range of a document, in order, and gives its elements; those that go over the end of a
    range are put together from their parts. With keys (one column), elements whose top-level field
    ``key`` is not among them go before they are parsed. Elements that are no objects are left out; keys of
    the path must not hold braces. Only a few numbers for each range come to the driver.
    """
    target = [["{", None]] if array else []
    target += [["{", name] for name in array[:-1]] + [["[", array[-1]]] if array else [["[", None]]
    lines = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    begins = _begins(lines.mapInPandas(_effects, "file string, start long, effect string").collect(), target)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None

        def row(origin: int | None, text: str, whole: bool) -> pd.DataFrame:
            return pd.DataFrame({"file": [now[0]], "origin": [origin], "start": [now[1]], "text": [text], "whole": [whole]})

        for file, start, text in _ranges(batches):
            if now != (file, start):
                if now and state["open"]:
                    yield row(state["origin"], "".join(state["open"]), False)
                now = (file, start)
                within, stack, origin = begins[now]
                inside = len(stack) > len(target) and stack[: len(target)] == target and stack[len(target)][0] == "{"
                state = {"within": within, "stack": list(stack), "open": [""] if inside else [], "origin": origin if inside else start, "cut": inside}
            stack, floor, begin, texts = state["stack"], 0, 0, []
            for at, token in _tokens(text, state["within"]):
                if at < 0:
                    state["within"] = token == '"'
                    continue
                if token in "{[":
                    if token == "{" and stack == target:
                        begin, state["open"], state["origin"], state["cut"] = at, [""], start, False
                    stack.append([token, _label(text, at, floor)])
                elif stack:
                    stack.pop()
                    if stack == target and state["open"]:
                        done = "".join(state["open"]) + text[begin : at + 1]
                        if state["cut"]:
                            yield row(state["origin"], done, False)
                        else:
                            texts.append(done)
                        state["open"], state["cut"] = [], False
                floor = at
            if state["open"]:
                state["open"].append(text[begin:])
            if texts:
                yield pd.DataFrame({"file": file, "origin": None, "start": start, "text": texts, "whole": True})
        if now and state["open"]:
            yield row(state["origin"], "".join(state["open"]), False)

    found = written(lines.mapInPandas(run, "file string, origin long, start long, text string, whole boolean"))
    parts = found.filter("not whole").groupBy("file", "origin").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "").alias("text"))
    each = found.filter("whole").select("file", "text").unionByName(parts.select("file", "text"))
    if keys is not None:
        wanted = keys.toDF("_key").distinct().withColumn("_key", F.col("_key").cast("string"))
        each = each.withColumn("_key", F.get_json_object("text", f"$.{key}")).join(wanted, "_key", "left_semi")
    return each.select("file", F.from_json("text", schema).alias("r")).select("file", "r.*")


def explode_nested(df: DataFrame, *levels: tuple[str, str], keys: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Explode array columns level by level (S09). Rows whose key, a dotted path, is not in keys (one
    column) go as soon as a level has made its first part, before deeper ones are exploded."""
    todo = keys is not None
    for path, name in [("", ""), *levels]:
        df = df.withColumn(name, F.explode(path)) if name else df
        if todo and key.split(".")[0] in df.columns:
            df = df.join(keys.toDF("_key").distinct(), F.col(key) == F.col("_key"), "left_semi")
            todo = False
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: Mapping[str, str] | None = None) -> DataFrame:
    """A relational table, one partition per pushed predicate."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties or {}))


def melt_crosstab(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns of a crosstab as rows, empty cells dropped."""
    return df.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull())


def melt_sheet(sheet: DataFrame, year: str = r"(?:19|20)\d\d") -> DataFrame:
    """label, year, value of a sheet (row_no, cells: array of texts) of one crosstab.

    The header is the first row with two cells or more that are a year; years may be followed by a mark.
    Rows above it, cells outside its year columns and rows without a number (footnotes, subtitles) are
    left out; footnote marks such as ``1/`` or ``*`` at a label's end are cut off. Thousands commas and
    brackets for negative numbers are read.
    """
    is_year = lambda c: F.trim(c).rlike(f"^(FY ?)?{year}\\W*$")
    heads = sheet.filter(F.size(F.filter("cells", lambda c: F.coalesce(is_year(c), F.lit(False)))) >= 2)
    head = heads.agg(F.min(F.struct("row_no", "cells")).alias("h")).select(F.col("h.row_no").alias("_at"), F.col("h.cells").alias("_years"))
    body = sheet.crossJoin(F.broadcast(head)).filter(F.col("row_no") > F.col("_at"))  # head: one row
    label = F.trim(F.regexp_replace(F.get("cells", F.lit(0)), r"(\s*(\d+/|\*+|\[\w\]))+\s*$", ""))
    each = body.select("row_no", label.alias("label"), "_years", F.posexplode("cells").alias("at", "cell"))
    text = F.regexp_replace(F.trim("cell"), "[,$\\s]", "")
    number = F.regexp_replace(text, r"^\((.*)\)$", "-$1").try_cast("double")
    found = each.select("label", F.get("_years", F.col("at")).alias("_y"), number.alias("value")).filter(is_year(F.col("_y")) & F.col("value").isNotNull())
    return found.select("label", F.regexp_extract("_y", f"({year})", 1).alias("year"), "value").filter("label <> ''")


def read_window(df: DataFrame, col: str, start: str, end: str, overlap_days: int = 0) -> DataFrame:
    """Rows modified in [start - overlap, end)."""
    return df.filter((F.col(col) >= F.date_sub(F.to_date(F.lit(start)), overlap_days)) & (F.col(col) < F.to_date(F.lit(end))))


def read_snapshot(df: DataFrame, col: str, label: str | None = None, as_of: str | None = None) -> DataFrame:
    """Rows of one snapshot: that of a label, the latest as of a label, or the latest."""
    if label is not None:
        return df.filter(F.col(col) == label)
    own = df.filter(F.col(col) <= as_of) if as_of is not None else df
    last = own.agg(F.max(col).alias("_last"))
    return own.join(F.broadcast(last), F.col(col) == F.col("_last")).drop("_last")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, length, content and its SHA-256 of every file that isn't empty."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", "content", F.sha2("content", 256).alias("content_hash"))


def with_content_hash(df: DataFrame, col: str) -> DataFrame:
    """The same hash for a table of texts."""
    return df.withColumn("content_hash", F.sha2(F.col(col), 256))
