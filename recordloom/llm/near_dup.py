"""MinHash near-duplicate classes with DartMinHash signatures.

A text is a weighted set of hashed five-word shingles, lower case, words cut at white space; a
shingle weighs as often as it occurs (``weights="set"``: once). DartMinHash throws darts into the
region [0, weight) x [0, rank) of every element; the darts come from the element's hash alone, so
that equal regions of two documents hold equal darts. Each dart carries a coordinate, and the
signature keeps the earliest dart for each coordinate: two signatures agree in a coordinate with
probability equal to the weighted Jaccard similarity, at a cost of about k ln k darts a document
instead of k hashes an element.

``classes`` then works on distinct texts:

1. Signatures are cut into ``bands`` of ``rows`` coordinates; texts that share a band's value form a
   bucket. Each bucket has one leader, the member that meets most other texts, and every other
   member is compared with it (exact weighted Jaccard), never all pairs. Links make components.
2. The members around a leader are its star. Where a star holds several components, two members may
   be linked without either being linked to the leader. Members differ in what only one of them has
   toggled against the leader (has where the leader lacks it, or lacks where the leader has it), and
   where together they have toggled more than linked texts may differ in, they must share some of it.
   They then share one of the foremost toggled elements in any common order (prefix filtering); the
   order is: rare elements of the star, then those of many members by their number, so that what sets
   the leader apart from all the others comes last. Members of a group that shares an element are
   compared if they are in different components, enough of their toggled elements lie from the shared
   one on (positional filtering) and their similarities to the leader differ by no more than linked
   texts' can (the distance is a metric). About ``BLOCK`` members of a group are compared with all
   others first, then turn by turn ``WIDER`` times as many; components found on the way drop the later
   pairs.
3. Components of all links are the classes. No link within a bucket is lost.

Two texts of similarity 0.8 share no bucket with probability (1 - 0.8**5)**24 = 7e-5.

Defined results: a null text counts as empty; texts without words are alike (similarity 1) and form
one class; texts of fewer than five words are one shingle; repeated rows are one text; null ids sort
last; an empty table gives no rows; further columns, whatever their names, are kept by ``dedup`` and
ignored by ``classes``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut
from .words import slices

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
BLOCK, WIDER = 8, 4  # members of a group that are first compared with all others; how many more each further time
OFTEN = 64  # elements of more than one in so many members of a star come last, by their number
TOLD = 1 << 17  # texts that every task is told of at most
SLACK = 1e-6  # of counts and their shares
COPIED = 1000
FIRST_RANK = 1 / 16  # the first region of ranks; each further one doubles the span
MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Shingles:
    """Sets of shingle hashes of texts, with a bounded cache of word hashes."""

    def __init__(self, words: int = WORDS, keep: int = 100_000):
        self.words, self.keep, self.known = words, keep, {}

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes and their counts."""
        import xxhash

        known = self.known
        if len(known) > self.keep:
            known.clear()
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.words, len(h))
        out = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            out = mix(out * STEP + h[i : len(h) - n + 1 + i])
        return np.unique(out, return_counts=True)


def occurrences(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sorted hashes of (element, 1st), (element, 2nd) .. occurrence: the weighted Jaccard similarity
    of two multisets is the plain one of these sets."""
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.repeat(elements, counts)
    return np.sort(np.where(nth == 0, flat, mix(flat + STEP * nth.astype(np.uint64))))


def _counts(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts by inversion."""
    terms, p = [], math.exp(-mean)
    total, i = p, 0
    while total < 1 - 1e-15 and i < 60 + 4 * mean:
        terms.append(total)
        i += 1
        p *= mean / i
        total += p
    return np.searchsorted(np.array(terms), u, side="right")


def dart_signatures(elements: list[np.ndarray], weights: list[np.ndarray] | None, k: int) -> np.ndarray:
    """Signatures [document, k] of weighted sets; an empty set gets zeros."""
    count = len(elements)
    out = np.full(count * k, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(e) for e in elements], np.int64)
    flat = np.concatenate(elements) if count else np.zeros(0, np.uint64)
    w = np.ones(len(flat)) if weights is None else np.concatenate(weights).astype(np.float64)
    doc = np.repeat(np.arange(count), sizes)
    total = np.bincount(doc, w, count)
    goal = k * (math.log(k) + 3)
    reach = goal / np.maximum(total, 1e-300)  # darts up to this rank are thrown
    open_docs = total > 0
    layers = 1 if weights is None else 1 + max(0, math.ceil(math.log2(max(w.max(initial=1), 1))))
    region, low = 0, 0.0
    while open_docs.any():
        high = FIRST_RANK * 2**region
        live_docs = open_docs & (reach > low)
        live = np.flatnonzero(live_docs[doc])
        if len(live):
            for layer in range(layers):
                bottom, top = (0.0, 1.0) if layer == 0 else (2.0 ** (layer - 1), 2.0**layer)
                own = live if layer == 0 else live[w[live] > bottom]
                if not len(own):
                    continue
                seed = mix(flat[own] + np.uint64((1 + region * 64 + layer) * int(STEP) % 2**64))
                number = _counts(unit(seed), (top - bottom) * (high - low))
                hit = np.flatnonzero(number)
                number = number[hit]
                at = np.repeat(own[hit], number)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(number) - number, number)
                dart = mix(np.repeat(seed[hit], number) + STEP * (nth + 1).astype(np.uint64))
                rank = low + unit(dart) * (high - low)
                second = mix(dart + STEP)
                if layer or weights is not None and w.min() < 1:
                    inside = bottom + unit(mix(second + STEP)) * (top - bottom) < w[at]
                    at, rank, second = at[inside], rank[inside], second[inside]
                place = doc[at] * k + (second % np.uint64(k)).astype(np.int64)
                value = (rank.view(np.uint64) & ~np.uint64(0xFFFFF)) | (second >> np.uint64(44))
                np.minimum.at(out, place, value)
        # a document is done when its ranks up to ``high`` filled every coordinate
        full = (out.reshape(count, k) != np.iinfo(np.uint64).max).all(axis=1)
        open_docs &= ~((reach <= high) & full)
        open_docs &= ~((low > 0) & full)
        reach = np.where(open_docs & (reach <= high), high * 2, reach)
        low, region = high, region + 1
    out = out.reshape(count, k)
    out[total == 0] = 0
    return out


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS, weights: str = "count") -> DataFrame:
    """doc_id, text_key, bands: one row per document; text_key is the MD5 of the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Shingles(words)
        salt = mix(np.arange(1, bands + 1).astype(np.uint64))
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in slices(texts, 1 << 20):
                sets = [made.of(t) for t in texts[a:b]]
                sig = dart_signatures([s[0] for s in sets], [s[1] for s in sets] if weights == "count" else None, bands * rows)
                key = np.zeros((b - a, bands), np.uint64)
                sig = sig.reshape(b - a, bands, rows)
                for r in range(rows):
                    key = mix(key * STEP + sig[:, :, r])
                key = mix(key + salt)
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].astype("Int64").values, "text_key": batch["text_key"].iloc[a:b].values, "bands": list(key.view(np.int64))})

    text = F.coalesce(F.col("text"), F.lit(""))
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))
    return rows_in.mapInPandas(run, "doc_id long, text_key binary, bands array<long>")


def shingle_sets(texts: DataFrame, words: int = WORDS, weights: str = "count") -> DataFrame:
    """rep, shingles of texts(rep, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Shingles(words)
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in slices(texts, 1 << 20):
                found = [made.of(t) for t in texts[a:b]]
                sets = [occurrences(*f) if weights == "count" else f[0] for f in found]
                yield pd.DataFrame({"rep": batch["rep"].iloc[a:b].values, "shingles": [s.view(np.int64) for s in sets]})

    return texts.mapInPandas(run, "rep long, shingles array<long>")


def _jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with sa, sb, their sets, and sim, the exact similarity of these."""
    left, right = sets.toDF("b", "sb"), sets.toDF("a", "sa")
    return pairs.join(left, "b").join(right, "a").withColumn("sim", _jaccard(F.col("sa"), F.col("sb")))


def components(links: DataFrame) -> DataFrame:
    """node, comp of links(a, b): least node of each component, by hooking and pointer jumping."""
    both = cut(links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).distinct())
    label = cut(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("comp")))
    while True:
        seen = both.join(label.toDF("other", "c"), "other").groupBy("node").agg(F.min("c").alias("c"))
        best = label.join(seen, "node").select("node", "comp", F.least("comp", "c").alias("new"))
        jump = label.select(F.col("node").alias("new"), F.col("comp").alias("to"))
        moved = cut(best.join(jump, "new", "left").select("node", F.col("comp").alias("old"), F.least("new", F.coalesce("to", "new")).alias("comp")))
        label = moved.select("node", "comp")
        if moved.filter("old <> comp").isEmpty():
            return label


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """label (node, comp) after further links (a, b): only links between components are searched."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    every = label.unionByName(ends.join(label, "node", "left_anti").withColumn("comp", F.col("node")))
    to = links.join(every.toDF("a", "ca"), "a").join(every.toDF("b", "cb"), "b").filter("ca <> cb")
    bridges = cut(to.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    if bridges.isEmpty():
        return label
    up = components(bridges).toDF("comp", "up")
    return cut(every.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")))


def _stars(members: DataFrame) -> DataFrame:
    """Distinct (a, b): the leaders of the buckets (key, rep, size) and the other members."""
    weighed = members.withColumn("weight", F.sum("size").over(Window.partitionBy("rep")))  # a text has one row a band
    best = weighed.groupBy("key").agg(F.max_by("rep", F.struct("weight", "rep")).alias("a"))
    return members.join(best, "key").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def _apart(sets: DataFrame) -> DataFrame:
    """a, b, sim, n, apart of compared pairs: what only one of b and its leader a has. Two members of a star
    differ in what only one of their ``apart`` has."""
    apart = F.concat(F.array_except("sb", "sa"), F.array_except("sa", "sb"))
    return sets.select("a", "b", "sim", F.size("sb").alias("n"), apart.alias("apart"))


def _rarest_first(stars: DataFrame) -> DataFrame:
    """stars with each ``apart`` in an order that its star has in common: rare elements, then those of more than
    BLOCK members and one in OFTEN, by their number. At most OFTEN times the mean size of ``apart`` are such."""
    of_star = stars.groupBy("a").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > BLOCK)
    each = stars.join(of_star, "a").select("a", "k", F.explode("apart").alias("element"))
    counts = each.groupBy("a", "element").agg(F.count(F.lit(1)).alias("c"), F.first("k").alias("k")).filter(F.col("c") > F.greatest(F.lit(BLOCK), F.col("k") / OFTEN))
    often = counts.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("c", "element"))).alias("often")).select("a", F.col("often.element").alias("often"))
    ordered = F.concat(F.array_except("apart", "often"), F.array_intersect("often", "apart"))
    return stars.join(often, "a", "left").withColumn("apart", F.when(F.col("often").isNull(), F.col("apart")).otherwise(ordered)).drop("often")


def _groups(stars: DataFrame, label: DataFrame, similarity: float) -> DataFrame:
    """g, rep, comp, n, sim, left, over, size: members of a star that share one of their foremost elements,
    where they are of several components. left: how many elements of ``apart`` begin there; over: by how many
    they exceed the member's share of what two linked texts may differ in; sim: its similarity to the leader."""
    own = stars.join(label.toDF("b", "comp"), "b", "left").withColumn("comp", F.coalesce("comp", "b"))
    mixed = own.groupBy("a").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("a")
    own = _rarest_first(cut(own.join(mixed, "a")))
    m, most = F.size("apart"), F.floor(F.col("n") * (1 / max(similarity, 1e-9) - 1) + SLACK) + 1  # linked texts differ in most - 1 elements
    over = m - F.col("n") * ((1 - similarity) / (1 + similarity))
    each = own.select("a", F.col("b").alias("rep"), "comp", "n", "sim", m.alias("m"), over.alias("over"), F.posexplode(F.slice("apart", F.lit(1), F.least(m, most).cast("int"))).alias("r", "element"))
    each = each.select(F.xxhash64("a", "element").alias("g"), "rep", "comp", "n", "sim", (F.col("m") - F.col("r")).alias("left"), "over")
    shared = each.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("over").alias("least"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    fits = each.join(shared, "g").filter(_enough(F.col("left"), F.col("over") + F.col("least")))
    return fits.select("g", "rep", "comp", "n", "sim", "left", "over", "size")


def _enough(left: Column, over: Column) -> Column:
    """Whether so many elements of ``apart`` that may be shared make up for the excess of both texts."""
    return 2 * left >= over - SLACK


def _turn(block: int) -> Column:
    """When a member of a group is compared with all whose turn is not before: about block members at first (0),
    then WIDER times as many up to each further turn."""
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << 40)) / float(1 << 40) * F.col("size") / block
    return F.when(place < 1, 0).otherwise(F.floor(F.log(place) / math.log(WIDER)) + 1).cast("int")


def _rest(groups: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) of a group's members at the given turn and those whose turn is not before."""
    few = groups.filter(F.col("turn") == turn).select("g", F.col("rep").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"), F.col("left").alias("ra"), F.col("over").alias("oa"), F.col("sim").alias("la"))
    many = groups.filter(F.col("turn") >= turn).select("g", F.col("rep").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("left").alias("rb"), F.col("over").alias("ob"), F.col("sim").alias("lb"), F.col("turn").alias("bt"))
    once = (F.col("bt") > turn) | (F.col("a") < F.col("b"))
    fits = _enough(F.least("ra", "rb"), F.col("oa") + F.col("ob")) & (F.least("na", "nb") >= F.greatest("na", "nb") * similarity - SLACK)
    near = F.abs(F.col("la") - F.col("lb")) <= 1 - similarity + 1e-9  # 1 - sim is a metric
    found = few.join(many, "g").filter((F.col("ca") != F.col("cb")) & once & fits & near)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mixed(groups: DataFrame, label: DataFrame) -> DataFrame:
    """groups with the components of label (node, comp), those of several ones only."""
    own = groups.drop("comp").join(label.toDF("rep", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    return own.join(own.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("g"), "g")


def _of_pairs(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets that pairs (a, b) need, where these are few enough to tell every task; else all of them."""
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    return sets.join(F.broadcast(ends), "rep", "left_semi") if ends.count() <= TOLD else sets


def _labels(members: DataFrame, sets: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """node, comp: components of all links within the buckets (key, rep, size)."""
    alike = F.col("sim") >= similarity - 1e-12
    stars = cut(_apart(compared(_stars(members), sets)))
    label = components(stars.filter(alike).select("a", "b"))
    groups = cut(_groups(stars, label, similarity).withColumn("turn", _turn(block)))
    seen = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    last, turn = groups.agg(F.max("turn")).first()[0], 0
    while last is not None and turn <= last:
        pairs = cut(_rest(groups, turn, similarity).join(seen, ["a", "b"], "left_anti"))
        label = merged(label, cut(compared(pairs, _of_pairs(sets, pairs)).filter(alike).select("a", "b")))
        turn += 1
        if turn <= last:
            groups = cut(_mixed(groups.filter(F.col("turn") >= turn), label))
            last = groups.agg(F.max("turn")).first()[0]
    return label


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, words: int = WORDS, weights: str = "count") -> DataFrame:
    """doc_id, text_key, class_key, class_id, class_size: one row per document.

    class_key is the least text key of the class, class_id its least doc_id (null if it has none),
    class_size the number of its rows.
    """
    sig = cut(signatures(docs, bands, rows, words, weights))
    texts = cut(sig.groupBy("text_key").agg(F.first("bands").alias("bands"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).withColumn("rep", F.monotonically_increasing_id()))
    banded = texts.select("rep", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut(banded.join(buckets, "key"))
    needed = members.select("rep").distinct().join(texts.select("rep", "text_key"), "rep")
    text = F.coalesce(F.col("text"), F.lit(""))
    # copies meet before the exchange, so that a text of many copies burdens no task
    one_each = docs.select(F.unhex(F.md5(text)).alias("text_key"), text.alias("text")).groupBy("text_key").agg(F.first("text").alias("text"))
    sets = cut(shingle_sets(one_each.join(needed, "text_key").select("rep", "text"), words, weights))
    label = _labels(members, sets, similarity)
    alone = texts.select("text_key", "rep", "least", "n")
    linked = label.toDF("rep", "comp").join(alone, "rep")
    of_class = linked.groupBy("comp").agg(F.min("text_key").alias("class_key"), F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    found = linked.select("text_key", "comp").join(of_class, "comp").drop("comp")
    every = alone.select("text_key", "least", "n").join(found, "text_key", "left")
    every = every.select("text_key", F.coalesce("class_key", "text_key").alias("class_key"), F.when(F.col("class_key").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", "n").alias("class_size"))
    rows = sig.select("doc_id", "text_key")
    # fewer than COPIED texts can have so many copies; their rows are not gathered by text
    often = F.broadcast(every.join(texts.filter(F.col("n") > rows.count() / COPIED).select("text_key"), "text_key"))
    return rows.join(often, "text_key").unionByName(rows.join(often.select("text_key"), "text_key", "left_anti").join(every, "text_key"))


def dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document of each class, that of the least doc_id (nulls last, then least text
    key); a row repeated with the same id and text stays once."""
    found = cut(classes(docs, similarity).withColumn("last", F.col("doc_id").isNull()))
    best = found.groupBy("class_key").agg(F.min(F.struct("last", "doc_id", "text_key")).alias("k")).select("k.doc_id", "k.text_key")
    copies = found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    same = F.col("best.doc_id").eqNullSafe(F.col("copies.doc_id")) & (F.col("best.text_key") == F.col("copies.text_key"))
    keep = best.alias("best").join(copies.alias("copies"), same).select("best.doc_id", "best.text_key", "copies.copies")
    # the rows travel in one column, so that no name of theirs can clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("id"), F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")))).alias("key"))
    kept = rows.join(keep, (F.col("key") == F.col("text_key")) & F.col("id").eqNullSafe(F.col("doc_id")))
    once = kept.filter("copies = 1").select("row.*")
    return once.unionByName(kept.filter("copies > 1").dropDuplicates(["id", "key"]).select("row.*"))


def query(docs: DataFrame) -> DataFrame:
    """The registered digest: class id and size of every document, and whether it stays."""
    out = classes(docs.select("doc_id", "text"))
    return out.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("keeps"))
