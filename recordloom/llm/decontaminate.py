"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items are sequences of words (``\\w+``, lower case). A document holds an item if some
stretch of it is within floor(max_edits * m) word edits of the item's m words. Windows of the item's
size are embedded by the CGK random walk: step i copies the symbol under the cursor and moves the
cursor on by a random bit that depends on i and the symbol, so that edit distance becomes Hamming
distance. ``walks`` x ``samples`` tables hash ``bits`` sampled steps each; a window that shares a
table's value with an item of its size is a candidate, and a semi-global alignment decides.

Only windows that can match are embedded: of an item cut into k + 1 parts, k edits leave a part
whole, so every true match holds a run of floor(m / (k + 1)) of the item's words, and windows are
laid where such a run lines up. The tables then lose some: with the defaults they keep 99 % of the
stretches at the largest allowed distance (the tests measure it by number of tables); exact copies
share every value.

The benchmark is read in blocks of about ``BLOCK_CHARS`` characters, one pass over the documents
each, so that what a task holds does not grow with it. Windows and items are embedded by classes of
length, at most ``CELLS`` words together, so that a long item burdens no short one.

Defined results: null or empty texts and items without words match nothing; an item id may be null;
items that repeat are reported each; repeated documents each give their rows; an empty table gives
no rows; other columns are ignored by ``matches`` and kept by ``clean``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .near_dup import STEP, mix
from .scratch import cut

MAX_EDITS = 0.2
WALKS, SAMPLES, BITS = 8, 8, 2
BLOCK_CHARS = 4_000_000
CELLS = 1 << 20  # words that are held and embedded together
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def embed(symbols: np.ndarray, sizes: np.ndarray, walk: int) -> np.ndarray:
    """CGK walks over rows of symbols (row i has sizes[i] of them, then pads of -1): [row, 2 x width]."""
    rows, width = np.arange(len(symbols)), symbols.shape[1]
    padded = np.concatenate([symbols, np.full((len(symbols), 1), -1, symbols.dtype)], axis=1)
    cursor = np.zeros(len(symbols), np.int64)
    out = np.empty((len(symbols), 2 * width), np.int64)
    seed = int(STEP) * (walk + 1)
    for i in range(2 * width):
        under = padded[rows, cursor]
        out[:, i] = under
        coin = mix(under.astype(np.uint64) + np.uint64((seed + i * 0xD1342543DE82EF95) % 2**64)) & np.uint64(1)
        cursor = np.minimum(cursor + coin.astype(np.int64), sizes)
    return out


def table_keys(symbols: np.ndarray, sizes: np.ndarray, walks: int = WALKS, samples: int = SAMPLES, bits: int = BITS) -> np.ndarray:
    """One value per row and table; steps are sampled over the first 2 x size of each row."""
    draw = np.random.default_rng(20)
    rows, out = np.arange(len(symbols))[:, None], []
    for walk in range(walks):
        walked = embed(symbols, sizes, walk)
        for _ in range(samples):
            at = (draw.random(bits)[None, :] * 2 * sizes[:, None]).astype(np.int64)
            key = mix(sizes.astype(np.uint64) + np.uint64((len(out) + 1) * int(STEP) % 2**64))
            for value in walked[rows, at].T:
                key = mix(key * STEP + value.astype(np.uint64))
            out.append(key)
    return np.stack(out, axis=1) if len(symbols) else np.zeros((0, walks * samples), np.uint64)


def distance(item: np.ndarray, stretch: np.ndarray) -> int:
    """Least number of word edits between item and any part of stretch."""
    index = np.arange(len(stretch) + 1)
    row = np.zeros(len(stretch) + 1, np.int64)
    for i, word in enumerate(item, 1):
        step = row + 1
        step[1:] = np.minimum(step[1:], row[:-1] + (stretch != word))
        step[0] = i
        row = np.minimum.accumulate(step - index) + index
    return int(row.min())


class Finder:
    """The items of one block, ready to be looked for."""

    def __init__(self, items: list[str], max_edits: float = MAX_EDITS):
        self.vocabulary: dict[str, int] = {}
        self.items, self.edits, seeds = [], [], defaultdict(list)
        for text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int64)
            self.items.append(ids)
            self.edits.append(int(max_edits * len(ids)))
        for number, (ids, k) in enumerate(zip(self.items, self.edits)):
            if len(ids):
                q = max(1, len(ids) // (k + 1))
                for place, h in enumerate(self._runs(ids, q).tolist()):
                    seeds[q, h].append((number, place))
        self.seeds = {q: {h: v for (own, h), v in seeds.items() if own == q} for q in {q for q, _ in seeds}}
        self.hashes = {q: np.array(sorted(v), np.uint64) for q, v in self.seeds.items()}
        sizes = np.array([len(i) for i in self.items], np.int64)
        self.tables = defaultdict(list)
        for rows, keys in keys_by_length(self.items, sizes):
            for number, row in zip(rows.tolist(), keys.tolist()):
                for key in row:
                    self.tables[key].append(number)
        self.known = np.array(sorted(self.tables), np.uint64)

    @staticmethod
    def _runs(ids: np.ndarray, q: int) -> np.ndarray:
        n = max(len(ids) - q + 1, 0)
        out = np.zeros(n, np.uint64)
        for i in range(q):
            out = mix(out * STEP + ids[i : i + n].astype(np.uint64))
        return out

    def windows(self, text: str) -> Iterator[tuple[int, int, np.ndarray]]:
        """start, size and the surroundings of every item-sized window that lines up with a run."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words_of(text)], np.int64)
        for q, hashes in self.hashes.items():
            if len(ids) < q:
                continue
            live = np.flatnonzero((ids[: len(ids) - q + 1] > 0) & (ids[q - 1 :] > 0))
            if not len(live):
                continue
            # runs are hashed only where both ends are words of the benchmark
            h = np.zeros(len(live), np.uint64)
            for i in range(q):
                h = mix(h * STEP + ids[live + i].astype(np.uint64))
            near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[near] == h)
            seen = set()
            for place, value in zip(live[hit].tolist(), h[hit].tolist()):
                for number, offset in self.seeds[q][value]:
                    start, size = place - offset, len(self.items[number])
                    if (start, size) not in seen:
                        seen.add((start, size))
                        edits = self.edits[number]
                        yield start, size, ids[max(start - edits, 0) : start + size + edits], ids[max(start, 0) : start + size], max(-start, 0)

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(item, edits, start) of the best stretch of each item that each text holds."""
        best: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        held, cells = [], 0
        for row, text in enumerate(texts):
            for window in self.windows(text):
                held.append((row, *window))
                cells += len(window[2])
                if cells >= CELLS:
                    self._decide(held, best)
                    held, cells = [], 0
        self._decide(held, best)
        return [[(item, *b[item]) for item in sorted(b)] for b in best]

    def _decide(self, held: list, best: list[dict[int, tuple[int, int]]]) -> None:
        parts = []
        for _, _, size, _, inside, lead in held:  # what lies beyond the text's ends matches nothing
            own = np.zeros(size, np.int64)
            own[lead : lead + len(inside)] = inside
            parts.append(own)
        tried: dict[tuple[int, bytes], int] = {}
        for rows, keys in keys_by_length(parts, np.array([h[2] for h in held], np.int64)):
            near = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
            for at, column in zip(*np.nonzero(self.known[near] == keys)):
                row, start, size, around, _, _ = held[rows[at]]
                for item in self.tables[int(keys[at, column])]:
                    if len(self.items[item]) != size:
                        continue
                    one = (item, around.tobytes())
                    if one not in tried:
                        tried[one] = distance(self.items[item], around)
                    if tried[one] <= self.edits[item]:
                        best[row][item] = min(best[row].get(item, (size + 1, 0)), (tried[one], max(start, 0)))


def keys_by_length(parts: list[np.ndarray], sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """table_keys of the parts that have words, as (their rows, keys), by classes of length in turn."""
    width = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    for w in np.unique(width[sizes > 0]).tolist():
        own = np.flatnonzero((width == w) & (sizes > 0))
        step = max(1, CELLS // w)
        for i in range(0, len(own), step):
            rows = own[i : i + step]
            symbols = np.full((len(rows), int(sizes[rows].max())), -1, np.int64)
            for place, row in zip(symbols, rows.tolist()):
                place[: sizes[row]] = parts[row]
            yield rows, table_keys(symbols, sizes[rows])


FOUND = "array<struct<item_id:long,edits:long,item_words:long,first_word:long>>"


def finder(spark: SparkSession, items: list[tuple[int | None, str]], max_edits: float = MAX_EDITS) -> Callable[[Column | str], Column]:
    """A column function: the items (item_id, text) that a text holds, as FOUND."""
    sent = spark.sparkContext.broadcast((Finder([t for _, t in items], max_edits), [i for i, _ in items]))  # of one block's size

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, ids = sent.value
        for texts in batches:
            found = own.find(texts.fillna("").tolist())
            yield pd.Series([[{"item_id": ids[i], "edits": e, "item_words": len(own.items[i]), "first_word": at} for i, e, at in f] for f in found], dtype=object)

    return find


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """(item_id, text) lists of bounded size that together are the whole benchmark."""
    items = cut(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        found = [(r.item_id, r.text) for r in items.filter(block == i).collect()]
        if found:
            yield found


def matches(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """doc_id, item_id, edits, item_words, first_word: a row for each item that a document holds."""
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, edits long, item_words long, first_word long")
    for items in blocks(benchmark):
        find = finder(docs.sparkSession, items, max_edits)
        out = out.unionByName(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(find("text"))))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """docs without those that hold an item; a document whose text is null stays."""
    for items in blocks(benchmark):
        docs = docs.filter(F.size(finder(docs.sparkSession, items, max_edits)("text")) == 0)
    return docs


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The registered result: every (document, item) pair."""
    return matches(docs, benchmark)
