"""Personal data: fixed patterns, and identifiers that bootstrapped contexts discover.

Fixed kinds are ``email``, ``ip``, ``card`` and ``phone``. What they find are the seeds. Every other token
that could be an identifier (an at sign, or four digits and more) is a candidate. Seeds and candidates
stand in lexical patterns:

* ``left``: the two words before,
* ``around``: the word before and the word behind (where the mention is one token).

Mentions and patterns are a bipartite graph, and Spark scores it in rounds. A pattern's score for a kind
is the share of all its occurrences in the corpus, plain words in its slot included, that known instances
of the kind fill (one occurrence more is counted as unknown); it is trusted from ``TRUST`` on, if
``INSTANCES`` different known instances speak for it. An instance's score is the mean over its mentions of
the best trusted pattern there; from ``ACCEPT`` on it is known, its kind the best one, and it speaks for
its other patterns in the next round. Rounds end when no instance is new, after ``ROUNDS`` at most.
Each mention of an instance found so is a span of its kind. Contexts that plain text fills never get
trust, so prose without telling contexts gets no further spans.

How often a pattern occurs takes one more pass over the texts. A bitmap of ``BITS`` bits, of one size
whatever the corpus, says which word pairs may be patterns; the few others that it lets through fall out
in the join. Instances and patterns are aggregated before they meet, so a copied document's mentions
are one row each.

Defined results: a null text counts as empty; offsets are code points, ends exclusive; words are runs
between the bytes 9-13 and 32, in lower case (A-Z); a missing word at a text's ends is the empty one; ties
of kinds go to the first named; repeated rows and null ids are rows like others; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut
from .words import slices

KINDS = ("email", "ip", "card", "phone")
TRUST, INSTANCES, ACCEPT, ROUNDS = 0.8, 4, 0.5, 5
BITS = 1 << 22
KNOWN = 500_000  # hashes of words that a task keeps
LONGEST = 64  # characters of a candidate; longer tokens are no identifiers of these kinds

# Fixed values of the base contract, without backtracking: each gives what its plain form gives.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TELLING = re.compile(r"@|[0-9][0-9 ().-]{2,}[0-9]")  # no candidate without
EDGES = ".,;:!?()[]{}<>\"'`*#&%$|=_~^/\\-"


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, behind, done = text.find("@"), 0, 0
    while at >= 0:
        before = text[max(behind, done) : at]
        n = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if n else None
        if domain:
            yield at - n, domain.end()
            done = domain.end()
        behind = at + 1
        at = text.find("@", behind)


def _ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _luhn(text: str) -> bool:
    digits = [int(c) for c in text if "0" <= c <= "9"][::-1]
    return 16 <= len(digits) <= 19 and sum(digits[::2] + [d * 2 - 9 * (d > 4) for d in digits[1::2]]) % 10 == 0


def _phone(text: str) -> bool:
    return 8 <= sum("0" <= c <= "9" for c in text) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed kinds, by kind, then start."""
    out = [(0, *s) for s in emails(text)] if "@" in text else []
    for kind, pattern, fits in ((1, IP, _ip), (2, CARD, _luhn), (3, PHONE, _phone)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if fits(m[0])]
    return out


class _Hashes(dict):
    """Hash of each word met."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


MIX = np.uint64(0x9E3779B97F4A7C15)


def pair_keys(first: np.ndarray, second: np.ndarray, side: int) -> np.ndarray:
    """Numbers of word pairs from the words' hashes; side tells ``left`` (0) from ``around`` (1)."""
    with np.errstate(over="ignore"):
        x = (first * MIX + np.uint64(side)) ^ (second >> np.uint64(7))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + second
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))).view(np.int64)


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(kind or None, start, end, instance, left, around or None) of seeds and candidates, by start.

    A seed inside another one of an earlier kind is none of its own (digits of an address in an email).
    """
    if not base and not TELLING.search(text):
        return []
    own: list[tuple[int, int, int | None]] = []
    for kind, start, end in base:
        if not any(a < end and start < b for a, b, _ in own):
            own.append((start, end, kind))
    seeds = sorted(own)
    words = [m.span() for m in WORD.finditer(text)]
    found, at = [], 0
    for n, (a, b) in enumerate(words):
        while at < len(seeds) and seeds[at][1] <= a:
            at += 1
        if at < len(seeds) and seeds[at][0] < b:  # some seed overlaps the token; those that begin in it
            k = at
            while k < len(seeds) and seeds[k][0] < b:
                if seeds[k][0] >= a:
                    found.append((*seeds[k], n))
                k += 1
        elif b - a >= 4:
            word = text[a:b]
            bare = word.strip(EDGES)
            if 4 <= len(bare) <= LONGEST and ("@" in bare or sum("0" <= c <= "9" for c in bare) >= 4):
                start = a + len(word) - len(word.lstrip(EDGES))
                found.append((start, start + len(bare), None, n))
    word = lambda i: xxhash.xxh3_64_intdigest(text[slice(*words[i])].encode().lower() if 0 <= i < len(words) else b"")
    out = []
    for start, end, kind, n in found:
        last = n
        while last + 1 < len(words) and words[last + 1][0] < end:
            last += 1
        pairs = [pair_keys(np.array([word(i)], np.uint64), np.array([word(j)], np.uint64), side)[0] for side, i, j in ((0, n - 2, n - 1), (1, n - 1, last + 1))]
        out.append((kind, start, end, text[start:end].encode().lower().decode(), int(pairs[0]), int(pairs[1]) if last == n else None))
    return out


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
MENTION = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("left", pa.int64()), ("around", pa.int64())])


def found(docs: DataFrame) -> DataFrame:
    """row, doc_id, base (spans of the fixed kinds), mentions; one row a document (row, doc_id, text)."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("base", pa.list_(SPAN)), ("mentions", pa.list_(MENTION))])
    names = [f.name for f in MENTION]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices(texts):
                base = [base_spans(t) for t in texts[a:b]]
                near = [mentions(t, s) for t, s in zip(texts[a:b], base)]
                spans = [[dict(zip(names, s)) for s in own] for own in base]
                columns = [pa.array(spans, pa.list_(SPAN)), pa.array([[dict(zip(names, m)) for m in own] for own in near], pa.list_(MENTION))]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), batch.column("doc_id").slice(a, b - a), *columns], schema=schema)

    span = "kind:int,start:long,end:long"
    return docs.mapInArrow(run, f"row long, doc_id long, base array<struct<{span}>>, mentions array<struct<{span},instance:string,left:long,around:long>>")


def occurrences(docs: DataFrame, patterns: DataFrame, bits: int = BITS) -> DataFrame:
    """pattern, total: how often each of patterns (pattern) occurs in the texts, whatever fills it."""
    place = f"pmod(pattern, {bits})"
    marked = patterns.groupBy(F.expr(f"{place} div 32").alias("w")).agg(F.expr(f"bit_or(shiftleft(1L, cast({place} % 32 as int)))").alias("b"))
    bitmap = np.zeros(bits // 32, np.uint32)
    for r in marked.collect():  # at most bits / 32 rows
        bitmap[r.w] = r.b
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    schema = pa.schema([("pattern", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, known = np.unpackbits(shared.value.view(np.uint8), bitorder="little").view(bool), _Hashes()
        edge = np.array([xxhash.xxh3_64_intdigest(b"")] * 2, np.uint64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices([t or "" for t in texts]):
                if len(known) > KNOWN:
                    known.clear()
                words = [(t or "").encode().lower().split() for t in texts[a:b]]  # of bytes: only A-Z, only bytes 9-13 and 32
                hashes = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64)
                keys, at = [], 0
                for own in map(len, words):
                    h = np.concatenate([edge, hashes[at : at + own], edge[:1]])
                    keys += [pair_keys(h[:-3], h[1:-2], 0), pair_keys(h[1:-2], h[3:], 1)]
                    at += own
                every = np.concatenate(keys)
                pattern, n = np.unique(every[marks[every % bits]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pattern, pa.int64()), pa.array(n, pa.int64())], schema=schema)

    seen = docs.select("text").mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return patterns.join(seen, "pattern")


def discover(docs: DataFrame, slots: DataFrame) -> DataFrame | None:
    """instance, kind of what the contexts discover; None if that is nothing.

    slots: kind, instance, left, around, n, one row for each different mention.
    """
    edges = slots.select("kind", "instance", "n", F.explode(F.array("left", "around")).alias("pattern")).filter("pattern is not null")
    edges = edges.groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
    many = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.sum("n").alias("filled")).filter(F.col("instances") >= INSTANCES)
    many = cut(many.select("pattern", "filled"))
    # a pattern that plain words fill too often can't be trusted in any round
    hopeful = occurrences(docs, many.select("pattern")).join(many, "pattern").filter(F.col("filled") / (F.col("total") + 1) >= TRUST)
    hopeful = cut(hopeful.select("pattern", "total"))
    if hopeful.isEmpty():
        return None
    edges = cut(edges.join(hopeful, "pattern"))
    known = cut(slots.filter("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind")))
    open_ = cut(slots.filter("kind is null").select("instance", "left", "around", "n"))
    mentions_ = cut(open_.groupBy("instance").agg(F.sum("n").alias("all")))
    out = None
    for _ in range(ROUNDS):
        spoken = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("instances"), F.first("total").alias("total"))
        score = F.col("n") / (F.col("total") + 1)
        trusted = cut(spoken.filter((F.col("instances") >= INSTANCES) & (score >= TRUST)).select("pattern", F.struct(score.alias("score"), (-F.col("kind")).alias("kind")).alias("t")))
        if trusted.isEmpty():
            break
        side = lambda name: trusted.select(F.col("pattern").alias(name), F.col("t").alias(f"_{name}"))
        met = open_.join(side("left"), "left", "left").join(side("around"), "around", "left").withColumn("best", F.greatest("_left", "_around"))
        met = met.filter("best is not null").withColumn("kind", -F.col("best.kind"))
        like = F.when(F.col("kind") == 0, F.contains("instance", F.lit("@"))).otherwise(~F.contains("instance", F.lit("@")))
        sums = met.filter(like).groupBy("instance", "kind").agg(F.sum(F.col("n") * F.col("best.score")).alias("score"))
        scored = sums.join(mentions_, "instance").filter(F.col("score") / F.col("all") >= ACCEPT)
        new = scored.groupBy("instance").agg(F.max(F.struct("score", -F.col("kind"))).alias("b")).select("instance", (-F.col("b.col2")).alias("kind"))
        new = cut(new.join(known, "instance", "left_anti"))
        if new.isEmpty():
            break
        out = new if out is None else out.unionByName(new)
        known = known.unionByName(new)
    return out


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, base and spans: array<struct<kind, start, end>> by kind, then start; kind indexes KINDS."""
    texts = docs.select(F.col(text_col).alias("text"))
    seen = cut(found(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"))))
    each = seen.select("row", F.inline("mentions"))
    slots = cut(each.groupBy("kind", "instance", "left", "around").agg(F.count(F.lit(1)).alias("n")))
    more = discover(texts, slots)
    if more is None:
        return seen.select("doc_id", "base", F.col("base").alias("spans"))
    met = each.filter("kind is null").drop("kind").join(more, "instance")
    own = met.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))  # of one document
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return seen.join(own, "row", "left").select("doc_id", "base", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(docs: DataFrame) -> DataFrame:
    """The registered digest over ``documents``."""
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    more = (F.size("spans") - F.size("base")).cast("long").alias("n_discovered")
    return scan(docs).select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), more)
