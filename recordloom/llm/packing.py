"""Harmonic packing of documents into token sequences.

A document's ids (its end id included) are cut into pieces: whole sequences first, then a piece of
any length whose reciprocal-capacity class fills a sequence with at most ``slack`` ids of padding.
A length l belongs to class j = capacity // l, and a sequence of class j holds j pieces. Pieces get
dealt over buckets, and each bucket fills its classes' sequences on its own. What a bucket has left
over (fewer than j pieces a class) meets the remainders of ``FAN`` buckets in the next level, until
one bucket remains. The last remainders, less than one sequence for each of the at most ~130
classes, are laid side by side, longest first, where they fit.

Defined results: a null or empty text is one piece that holds only the end id; repeated rows and
null ids are packed like any other row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut
from .words import WordIds, slices

CAPACITY = 4096
END_ID = 2
SLACK = 64
BUCKET_PIECES = 50_000
FAN = 64
TOKENIZER = "word_bpe_49k.json"


def piece_lengths(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths that sum to n; j = capacity // length of them leave at most slack ids unused."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        j = capacity // n
        length = n if capacity - j * n <= slack else capacity // (j + 1)
        out.append(length)
        n -= length
    return out


def pieces(docs: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, spread: one row per piece."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        ids_of, seen = WordIds(public_tokenizers.path(tokenizer)), 0
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            for a, b in slices(texts, 1 << 20):
                rows = []
                for doc, ids in zip(batch["doc_id"].iloc[a:b].tolist(), ids_of.encode(texts[a:b])):
                    data = np.append(ids, END_ID).astype("<u4").tobytes()
                    n, start = len(data) // 4, 0
                    doc = None if pd.isna(doc) else int(doc)
                    for length in piece_lengths(n, capacity, slack):
                        seen += 1
                        rows.append((doc, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), n, seen))
                        start += length
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "spread"])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, spread long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, kind)


def _lay(rows: pd.DataFrame) -> pd.DataFrame:
    """Remainder runs, longest first, into sequences; at most one run for each class comes here."""
    rows = rows.sort_values(["total", "j"], ascending=[False, True])
    room, out = [], []
    for j, total, capacity in rows[["j", "total", "capacity"]].itertuples(index=False):
        at = next((i for i, free in enumerate(room) if free >= total), len(room))
        if at == len(room):
            room.append(capacity)
        out.append((j, at, capacity - room[at]))
        room[at] -= total
    return pd.DataFrame(out, columns=["j", "bin", "shift"])


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """cut_pieces with sequence_id and offset. Read it from a written table: it is read repeatedly."""
    buckets = max(1, -(-cut_pieces.count() // bucket_pieces))
    cols = [c for c in cut_pieces.columns if c != "spread"]
    h = F.xxhash64("doc_id", "start", "ids_crc32", "spread")
    left = cut_pieces.withColumn("j", F.lit(capacity).cast("long").__truediv__(F.col("length")).cast("long")).withColumn("bucket", F.pmod(h, F.lit(buckets)))
    done, level = [], 0
    while True:
        group = Window.partitionBy("bucket", "j")
        ranked = left.withColumn("rn", F.row_number().over(group.orderBy("doc_id", "start", "ids_crc32")) - 1).withColumn("n", F.count(F.lit(1)).over(group))
        ranked = ranked.withColumn("bin", F.floor(F.col("rn") / F.col("j")))
        whole = (F.col("bin") + 1) * F.col("j") <= F.col("n")
        inside = Window.partitionBy("bucket", "j", "bin").orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        number = F.shiftleft(F.lit(level).cast("long"), 60) + F.shiftleft(F.col("bucket").cast("long"), 36) + F.shiftleft(F.col("j"), 23) + F.col("bin")
        done.append(ranked.filter(whole).select(*cols, number.alias("sequence_id"), (F.sum("length").over(inside) - F.col("length")).alias("offset")))
        left = cut(ranked.filter(~whole).drop("rn", "n", "bin"))
        if buckets == 1:
            break
        buckets = -(-buckets // FAN)
        level += 1
        left = left.withColumn("bucket", F.floor(F.col("bucket") / FAN))
    run = Window.partitionBy("j").orderBy("doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = left.groupBy("j").agg(F.sum("length").alias("total")).withColumn("capacity", F.lit(capacity))
    laid = runs.groupBy("capacity").applyInPandas(_lay, "j long, bin long, shift long")
    last = left.withColumn("offset", F.sum("length").over(run) - F.col("length")).join(F.broadcast(laid), "j")
    number = F.shiftleft(F.lit(7).cast("long"), 60) + F.col("bin")
    out = last.select(*cols, number.alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"))
    for part in done:
        out = out.unionByName(part)
    return out


def query(docs: DataFrame) -> DataFrame:
    """The registered digest: one row per piece with its place."""
    return pack(cut(pieces(docs)))
