"""Text: chunks, extraction by patterns, sections, vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.keys import fold_key
from recordloom.functions.values import spans


def normal_space(text: Column) -> Column:
    """One line end, single blanks, at most one empty line in a row, nothing at either end."""
    rules = (("\r\n?", "\n"), ("[ \t]+", " "), ("\n{3,}", "\n\n"))
    return F.btrim(reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, F.coalesce(text, F.lit(""))), F.lit(" \n\t"))


def chunk(df: DataFrame, key: str, text: str, size: int = 2000, overlap: int = 200) -> DataFrame:
    """key, chunk, offset, piece: overlapping chunks of whole texts.

    Chunk i covers the places i x (size - overlap) to that plus size of the normal_space text, on a grid
    that depends on no earlier chunk. Both places move back to just behind the last blank within overlap
    characters, where there is one. Neighbours leave no gap; an empty text has no chunk.
    """
    stride = size - overlap
    own = df.select(F.col(key).alias("key"), normal_space(F.col(text)).alias("body")).withColumn("n", F.length("body"))
    number = F.greatest(F.ceil((F.col("n") - overlap) / stride), F.lit(1)).cast("int")
    each = own.filter("n > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0), number - 1)))

    def place(at: Column) -> Column:
        begin = F.greatest(at - overlap, F.lit(0))
        back = F.instr(F.reverse(F.substring(F.col("body"), begin + 1, at - begin)), " ")
        return F.when(at <= 0, 0).when(at >= F.col("n"), F.col("n")).when(back > 0, at - back + 1).otherwise(at)

    placed = each.withColumn("offset", place(F.col("chunk") * stride)).withColumn("stop", place(F.col("chunk") * stride + size))
    return placed.select(F.col("key").alias(key), "chunk", "offset", F.substring(F.col("body"), F.col("offset") + 1, F.col("stop") - F.col("offset")).alias("piece"))


def reassemble(chunks: DataFrame, key: str) -> DataFrame:
    """key, text, spans of each text from its chunks (T02); spans give where each chunk's new part starts.

    A document's chunks meet in one group; their number is bounded by the document.
    """

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        text, spans = "", []
        for n, offset, piece in group[["chunk", "offset", "piece"]].itertuples(index=False):
            if offset > len(text):
                text += " " * (offset - len(text))
            spans.append(f"{n}:{len(text)}")
            text += piece[len(text) - offset :] if offset < len(text) else piece
        return pd.DataFrame({key: [group[key].iloc[0]], "text": [text], "spans": [",".join(spans)]})

    kind = chunks.schema[key].dataType.simpleString()
    return chunks.groupBy(key).applyInPandas(join, f"{key} {kind}, text string, spans string")


def dedup_exact(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, content_hash, canonical_id (least key with the content), copies."""
    hashed = df.select(key, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("content_hash"))
    stats = hashed.groupBy("content_hash").agg(F.min(key).alias("canonical_id"), F.count(F.lit(1)).alias("copies"))
    return hashed.join(stats, "content_hash")


def triage(text: Column, head: int, classes: Mapping[str, str], lexicon: str) -> tuple[Column, Column]:
    """Class of the first pattern in the head, ``unknown`` else; whether the lexicon occurs anywhere."""
    start = F.substring(text, 1, head)
    out = None
    for name, pattern in classes.items():
        out = F.when(start.rlike(pattern), name) if out is None else out.when(start.rlike(pattern), name)
    return out.otherwise("unknown"), text.rlike(lexicon)


def markings(text: Column, patterns: Mapping[str, str]) -> Column:
    """Names of all patterns that occur, in their order."""
    return F.filter(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in patterns.items()]), lambda x: x.isNotNull())


def promote(old: Column, new: Column) -> Column:
    """Markings only ever grow."""
    return F.array_union(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>")))


def named_spans(text: Column, patterns: Mapping[str, str]) -> Column:
    """array<struct<name, start, end, value>> of the matches of several patterns, pattern by pattern."""

    def leg(name: str, pattern: str) -> Column:
        return F.transform(spans(text, pattern), lambda s: F.struct(F.lit(name).alias("name"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    return F.flatten(F.array(*[leg(n, p) for n, p in patterns.items()]))


REACH = 100  # characters that a negation itself may have


def extract(df: DataFrame, key: str, text: str, families: Mapping[str, str], negation: str, window: int = 40, margin: int = 30, mandatory: str = "must|shall|required") -> DataFrame:
    """key, family, value, n, start, end, quote, mandatory: distinct matches of pattern families.

    A match is dropped if a negation ends within ``window`` characters before it in the same sentence: only
    what stands there is searched for one. start, end and quote (the match with ``margin`` characters on both
    sides) are those of the first; mandatory: one of the quotes has such a word. Offsets are code points.
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def shown(f: Column) -> Column:
        first, back = F.greatest(f["start"] - margin, F.lit(0)), F.greatest(f["start"] - window - REACH, F.lit(0))
        quote = F.substring(body, first + 1, f["end"] + margin - first)
        before = F.substring(body, back + 1, f["start"] - back)
        return F.struct(f["name"].alias("family"), f["value"].alias("value"), f["start"].alias("start"), f["end"].alias("end"), quote.alias("quote"), before.alias("before"))

    free = lambda f: ~f["before"].rlike(f"(?:{negation})[^.]{{0,{window}}}\\z")
    found = F.filter(F.transform(named_spans(F.col(text), families), shown), free)
    quoted = df.select(F.col(key).alias("key"), F.explode(found).alias("f")).select("key", "f.*").drop("before")
    once = quoted.groupBy("key", "family", "value").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("start", "end", "quote")).alias("b"), F.max(F.col("quote").rlike(mandatory)).alias("mandatory"))
    return once.select(F.col("key").alias(key), "family", "value", "n", "b.start", "b.end", "b.quote", "mandatory")


def designations(df: DataFrame, key: str, text: str, stems: Mapping[str, str], negation: str, window: int = 60, listed: int = 3, listed_window: int = 200) -> DataFrame:
    """key, stem, start, end, context of every stem's match.

    context: negated, if a negation's middle is within ``window`` of the match's; else listed, if
    ``listed`` different stems have one within half the ``listed_window``; else binding.
    """
    middle = lambda s: F.floor((s["start"] + s["end"]) / 2)
    hits = F.transform(named_spans(F.col(text), stems), lambda s: F.struct(s["name"].alias("stem"), s["start"].alias("start"), s["end"].alias("end"), middle(s).alias("mid")))
    own = df.select(F.col(key).alias("key"), hits.alias("hits"), F.transform(spans(F.col(text), negation), middle).alias("no"))
    each = own.select("key", "hits", "no", F.explode("hits").alias("h"))
    near = F.filter("hits", lambda o: F.abs(o["mid"] - F.col("h.mid")) <= listed_window // 2)
    context = F.when(F.exists("no", lambda m: F.abs(m - F.col("h.mid")) <= window), "negated").when(F.size(F.array_distinct(F.transform(near, lambda o: o["stem"]))) >= listed, "listed").otherwise("binding")
    return each.select(F.col("key").alias(key), "h.stem", "h.start", "h.end", context.alias("context"))


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no, line."""
    return df.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line"))


def parse_register(df: DataFrame, key: str, text: str, code: str = r"\d{5}") -> tuple[DataFrame, DataFrame]:
    """Rows (key, code, title, rate) of ``code title....rate`` lines, the last rate of a code wins; lines that hold a rate but fit no row.

    code: pattern of a code, without groups.
    """
    pattern = rf"^\s*({code})\s+(.*?)\s*\.{{2,}}\s*\$?\s*(\d+\.\d+)"
    rows = lines(df, key, text)
    part = lambda i: F.regexp_extract("line", pattern, i)
    good = rows.filter(F.col("line").rlike(pattern)).select(key, "line_no", part(1).alias("code"), part(2).alias("title"), part(3).cast("double").alias("rate"))
    last = good.groupBy(key, "code").agg(F.max(F.struct("line_no", "title", "rate")).alias("b")).select(key, "code", "b.title", "b.rate")
    return last, rows.filter(~F.col("line").rlike(pattern) & F.col("line").rlike(r"\d+\.\d{2}"))


def sections(df: DataFrame, key: str, text: str, anchor: str) -> DataFrame:
    """key, section, title, n_lines, n_chars: lines under the last anchor line before them."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines(df, key, text).withColumn("section", F.sum(F.col("line").rlike(anchor).cast("int")).over(w))
    title = F.max(F.when(F.col("line").rlike(anchor), F.col("line")))
    return marked.groupBy(key, "section").agg(title.alias("title"), F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def mentions(df: DataFrame, key: str, col: str, separator: str) -> DataFrame:
    """fold, form, n_mentions, n_keys: list members by fold key with their most frequent form."""
    member = df.select(key, F.explode(F.split(F.lower(col), separator)).alias("form")).filter("trim(form) <> ''").withColumn("form", F.trim("form")).withColumn("fold", fold_key(F.col("form")))
    forms = member.groupBy("fold", "form").agg(F.count(F.lit(1)).alias("n"))
    best = forms.groupBy("fold").agg(F.min(F.struct((-F.col("n")).alias("c"), "form")).alias("b"), F.sum("n").alias("n_mentions"))
    keys = member.groupBy("fold").agg(F.count_distinct(key).alias("n_keys"))
    return best.join(keys, "fold").select("fold", F.col("b.form").alias("form"), "n_mentions", "n_keys")


def bucket(col: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Name of the first rule whose pattern occurs."""
    out = F.lit(default)
    for pattern, name in reversed(rules):
        out = F.when(col.rlike(pattern), name).otherwise(out)
    return out


def normalise_axes(df: DataFrame, key: str, col: str, aliases: DataFrame, split: str = "[^a-z0-9]+") -> tuple[DataFrame, DataFrame]:
    """(key, axis, code) of tokens with an alias (token, axis, code); tokens without one."""
    token = df.select(key, F.explode(F.array_distinct(F.split(F.lower(F.coalesce(col, F.lit(""))), split))).alias("token")).filter("token <> ''")
    return token.join(aliases, "token").select(key, "axis", "code").distinct(), token.join(aliases, "token", "left_anti")


def alias_lookup(aliases: DataFrame, queries: DataFrame) -> DataFrame:
    """query, code of the best source (T14). aliases: title, code, priority; queries: query."""
    folded = aliases.select(fold_key(F.lower("title")).alias("f"), "code", "priority")
    met = queries.select("query", fold_key(F.lower("query")).alias("f")).join(folded, "f")
    return met.groupBy("query").agg(F.min(F.struct("priority", "code")).alias("b")).select("query", "b.code", "b.priority")


def validate_tags(tags: DataFrame, vocab: DataFrame, texts: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Tag rows (key, tag, quote) whose tag is in the vocabulary and whose quote is in the text; the rest with a reason."""
    known = tags.join(vocab.select("tag").distinct().withColumn("_k", F.lit(True)), "tag", "left").join(texts.select(key, F.col(text).alias("_t")), key, "left")
    reason = F.when(F.col("_k").isNull(), "tag").when(~F.coalesce(F.contains("_t", "quote"), F.lit(False)), "quote")
    judged = known.withColumn("reason", reason).drop("_k", "_t")
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def homepage_meta(df: DataFrame, html: str) -> DataFrame:
    """title, description, lang and whether the page looks parked."""
    page = F.coalesce(F.col(html), F.lit(""))
    pick = lambda p: F.nullif(F.trim(F.regexp_extract(page, p, 1)), F.lit(""))
    title = pick("(?is)<title[^>]*>(.*?)</title>")
    parked = F.lower(page).rlike("domain (is )?for sale|buy this domain|parked (free|domain)|under construction")
    return df.withColumns({"title": title, "description": pick('(?is)<meta\\s+name="description"\\s+content="([^"]*)"'), "lang": pick('(?i)<html[^>]*lang="([^"]*)"'), "parked": parked})
