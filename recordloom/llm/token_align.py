"""Cross-tokenizer alignment: tokens of two vocabularies over the same bytes, cut into common groups.

A text's tokens under A (byte-level BPE) and B (BPE with byte fallback) are laid over the bytes of
space + text. Offsets at which both end a token close a group; the two tokens that end there are linked.

Texts are composed from fragments. A fragment of a byte range is an open prefix, whose tokens hang on bytes
before the range, closed groups, and an open suffix, which hangs on bytes behind it. A range is closed
between its *cuts*, spaces behind a character that is no white space: neither tokenizer joins bytes across
one (A's pattern begins a part there, and no piece of B has a space behind another character, which is
checked), so what lies between two cuts is encoded on its own. A range without a cut is all open.
``compose`` joins two neighbours: the left suffix and the right prefix become one open text, and what
closes in it lies between the closed groups of both. This is associative, with the empty range as
identity, so ranges of a long document are encoded by different tasks and meet in a tree, ``FAN`` at a
time. Only open texts climb the tree; closed groups stay in written tables under the number of their
place, and a document's hash reads them in that order as a stream. At a document's ends the outer
open texts close.

Within a task the parts between cuts are looked up in a bounded cache: equal parts have equal tokens.

Pair counts: a linked pair ends at one place, so the bytes of one token end with those of the other. There are
at most as many such pairs as the two vocabularies have bytes, whatever the corpus; the table of
counts is broadcast on that ground.

Defined results: null and empty texts, and those that one of the tokenizers does not give back byte by byte,
have no tokens (zeros and ''); special tokens' strings are plain text; repeated rows and null ids are rows
like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut
from .words import byte_letters, ragged, slices

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK = 1 << 16  # bytes of a range; longer documents are encoded by ranges
FAN = 16
KEEP = 150_000
CUT = re.compile(r"(?<=\S) ")
SHIFT = 1 << 20  # a pair of ids as one number: a * SHIFT + b


@dataclass
class Body:
    """Closed groups of one stretch: their text, links as numbers, counts, and whether all bytes came back."""

    groups: str
    links: np.ndarray
    n_a: int
    n_b: int
    whole: bool


@dataclass
class Fragment:
    """The open texts of a range; without a cut, head is all of it. tail begins with the last cut's space."""

    head: str = ""
    closed: bool = False
    tail: str = ""


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, str | None]:
    """The fragment of two neighbouring ranges, and the text (behind a cut's space) that closes between them.

    None: nothing closes.
    """
    seam = (left.tail if left.closed else left.head) + right.head
    cuts = [0] * left.closed + [m.start() for m in CUT.finditer(seam)] + [len(seam)] * right.closed
    if not cuts:
        return Fragment(seam), None
    first, last = cuts[0], cuts[-1]
    out = Fragment(left.head if left.closed else seam[:first], True, right.tail if right.closed else seam[last:])
    return out, seam[first + 1 : last] if first < last else None


def _ranked(ranks: dict[bytes, int]):
    """The same byte-level vocabulary in a faster and smaller library, in which special tokens' strings are text."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Encodes parts between cuts; ``keep`` bounds the cache."""

    def __init__(self, a_path: str, b_path: str, keep: int = KEEP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.b, self.keep = sentencepiece.SentencePieceProcessor(model_file=b_path), keep
        a = Tokenizer.from_file(a_path)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        specials = a.get_added_tokens_decoder()
        self.a_bytes = {i: t.encode() if i in specials else bytes(letters[c] for c in t) for t, i in a.get_vocab().items()}
        self.a = _ranked({b: i for i, b in self.a_bytes.items() if i not in specials})
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for _, p in pieces):
            raise ValueError(f"{b_path} has pieces with a space behind other characters")
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.a_sizes = np.array([len(self.a_bytes[i]) for i in range(len(self.a_bytes))])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # a token's text with what follows it: another of its side, the other side, a group, a part
        ids = [[str(i) for i in range(n)] for n in (len(self.a_sizes), len(self.b_sizes))]
        self.texts = [t + mark for own, marks in zip(ids, (",|", ",;\n")) for mark in marks for t in own]
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.flat, self.counts = np.zeros(0, np.int64), np.zeros((0, 4), np.int64)  # of links; links, a, b, whole
        self.begins = np.zeros(0, np.int64)

    def _keep(self, parts: list[str], groups: list[str], links: np.ndarray, counts: np.ndarray) -> None:
        self.place.update(zip(parts, range(len(self.place), len(self.place) + len(parts))))
        self.groups += groups
        self.begins = np.append(self.begins, len(self.flat) + np.cumsum(counts[:, 0]) - counts[:, 0])
        self.counts, self.flat = np.concatenate([self.counts, counts]), np.append(self.flat, links)

    def _learn(self, parts: list[str]) -> None:
        """Parts that end with no white space are encoded as one text, since each begins at a cut of it."""
        if len(parts) == 1 or any(not p or p[-1].isspace() for p in parts):
            plain = [p for p in parts if p and not p[-1].isspace()] if len(parts) > 1 else []
            for p in parts if len(parts) == 1 else [p for p in parts if not p or p[-1].isspace()]:
                # the last part of a text may be empty, and the space before it then stands alone
                b_ids = self.b.encode(p) if p else [self.b.piece_to_id("▁")]
                self._laid([p], np.array(self.a.encode_ordinary(" " + p), np.int64), np.array(b_ids, np.int64))
            if plain:
                self._learn(plain)
            return
        text = " ".join(parts)
        self._laid(parts, np.array(self.a.encode_ordinary(" " + text), np.int64), np.array(self.b.encode(text), np.int64))

    def _laid(self, parts: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Keep the groups of parts from the tokens of both over all of them."""
        want = "".join([" " + p for p in parts]).encode()
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != want or b"".join(map(self.a_bytes.__getitem__, a.tolist())) != want:
            if len(parts) == 1:
                self._keep(parts, [""], np.zeros(0, np.int64), np.array([[0, 0, 0, 0]]))
            else:  # some part does not come back: the halves tell which
                self._learn(parts[: len(parts) // 2])
                self._learn(parts[len(parts) // 2 :])
            return
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])  # of parts; both sides end a token there
        a_shut, b_shut = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
        n_a, n_b = len(self.a_sizes), len(self.b_sizes)
        last = np.isin(b_ends, ends, assume_unique=True)
        codes = np.concatenate([a + n_a * a_shut, b + 2 * n_a + n_b * b_shut + n_b * last])
        # by group, A before B
        group = np.concatenate([2 * np.searchsorted(b_ends[b_shut], a_ends), 2 * np.searchsorted(b_ends[b_shut], b_ends) + 1])
        text = "".join(map(self.texts.__getitem__, codes[np.argsort(group, kind="stable")].tolist()))
        of = [np.searchsorted(ends, x) for x in (a_ends[a_shut], a_ends, b_ends)]
        counts = np.stack([*(np.bincount(x, minlength=len(parts)) for x in of), np.ones(len(parts), np.int64)], axis=1)
        self._keep(parts, text.split("\n")[:-1], a[a_shut] * SHIFT + b[b_shut], counts)

    def bodies(self, texts: list[str]) -> list[Body]:
        """Bodies of texts that begin behind a cut's space (or the one before a document) and end before a cut or
        with the document. A document's empty text has no tokens; between cuts none is empty but the last."""
        if len(self.place) > self.keep:
            self._clear()
        parts = [CUT.split(t) for t in texts]
        sizes = [len(p) for p in parts]
        at = np.fromiter(map(self.place.get, chain.from_iterable(parts), repeat(-1)), np.int64)
        new = at < 0
        if new.any():
            missing = list(compress(chain.from_iterable(parts), new.tolist()))
            self._learn(list(dict.fromkeys(missing)))
            at[new] = np.fromiter(map(self.place.__getitem__, missing), np.int64, len(missing))
        out, ends, groups = [], np.cumsum([0, *sizes]), self.groups
        for own in (at[x:y] for x, y in zip(ends, ends[1:])):
            rows = self.counts[own]
            n_links, n_a, n_b, whole = rows.sum(0)
            if whole < len(own):
                out.append(Body("", EMPTY.links, 0, 0, False))
                continue
            links = self.flat[ragged(self.begins[own], rows[:, 0])]
            out.append(Body(";".join([groups[i] for i in own.tolist()]), links, int(n_a), int(n_b), True))
        return out


def _aligner(a_file: str, b_file: str) -> Aligner:
    import public_tokenizers

    return Aligner(public_tokenizers.path(a_file), public_tokenizers.path(b_file))


BODY = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("groups", pa.string()), ("links", pa.list_(pa.int64())), ("n_a", pa.int64()), ("n_b", pa.int64()), ("whole", pa.bool_())])
BODY_DDL = "row long, place long, groups string, links array<long>, n_a long, n_b long, whole boolean"
OPEN = pa.schema([("doc_id", pa.int64()), ("index", pa.int64()), ("head", pa.string()), ("closed", pa.bool_()), ("tail", pa.string())])
OPEN_DDL = "doc_id long, index long, head string, closed boolean, tail string"


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def _table(rows: list[tuple[int, int, Body]]) -> list[pa.Array]:
    """Columns of BODY."""
    bodies = [b for _, _, b in rows]
    return [
        pa.array([r for r, _, _ in rows], pa.int64()), pa.array([p for _, p, _ in rows], pa.int64()),
        pa.array([b.groups for b in bodies], pa.string()), _lists([b.links for b in bodies]),
        pa.array([b.n_a for b in bodies], pa.int64()), pa.array([b.n_b for b in bodies], pa.int64()), pa.array([b.whole for b in bodies], pa.bool_()),
    ]


def _ranges(data: bytes, size: int) -> Iterator[str]:
    """Byte ranges of about size, each begun at a character."""
    a = 0
    while a < len(data):
        b = min(a + size, len(data))
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        yield data[a:b].decode()
        a = b


def short_documents(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, groups_sha256, links of documents (row, doc_id, text) encoded whole."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_file, b_file)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices(texts, 1 << 20):
                own = [x if t else EMPTY for x, t in zip(aligner.bodies(texts[a:b]), texts[a:b])]
                hashes = [hashlib.sha256(x.groups.encode()).hexdigest() if x.groups else "" for x in own]
                columns = [batch.column("row").slice(a, b - a), batch.column("doc_id").slice(a, b - a), *[pa.array([getattr(x, k) for x in own], pa.int64()) for k in ("n_a", "n_b")]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(x.links) for x in own], pa.int64()), pa.array(hashes, pa.string()), _lists([x.links for x in own])], schema=schema)

    return docs.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>")


def _cut_up(docs: DataFrame, size: int) -> DataFrame:
    """row, doc_id, index, part: the byte ranges of documents."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("index", pa.int64()), ("part", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, text in enumerate(batch.column("text")):
                for i, part in enumerate(_ranges(text.as_py().encode(), size)):
                    own = [batch.column(k).slice(n, 1) for k in ("row", "doc_id")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array([i], pa.int64()), pa.array([part], pa.string())], schema=schema)

    return docs.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, index long, part string")


def _leaves(parts: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """The fragment of each range beside its closed groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_file, b_file)
        for batch in batches:
            index, texts = batch.column("index").to_pylist(), batch.column("part").to_pylist()
            rows = batch.column("row").to_pylist()
            for a, b in slices(texts, 1 << 20):
                # a range composed with the empty one on either side gives its own fragment
                made = [compose(Fragment(t), Fragment()) for t in texts[a:b]]
                bodies = aligner.bodies([c or "" for _, c in made])
                known = [(r, 2 * i, body if c is not None else EMPTY) for r, i, (_, c), body in zip(rows[a:b], index[a:b], made, bodies)]
                yield _with_open(known, batch.column("doc_id").slice(a, b - a), index[a:b], [f for f, _ in made])

    return parts.mapInArrow(run, f"{BODY_DDL}, {OPEN_DDL}")


def _with_open(known: list[tuple[int, int, Body]], doc_ids: pa.Array, index: list, fragments: list) -> pa.RecordBatch:
    """Bodies beside open texts; either may be lacking in a row."""
    fields = [[f and getattr(f, k) for f in fragments] for k in ("head", "closed", "tail")]
    return pa.RecordBatch.from_arrays([*_table(known), doc_ids, pa.array(index, pa.int64()), *[pa.array(v, t.type) for v, t in zip(fields, list(OPEN)[2:])]], schema=pa.schema([*BODY, *OPEN]))


def _meet(fragments: DataFrame, width: int, last: bool, a_file: str, b_file: str) -> DataFrame:
    """FAN neighbours of a document become one fragment (row 'open') beside the groups that closed on the way.

    width: how many ranges a fragment spans. last: no neighbours remain, so the ends close too.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        row, index = group.column("row")[0].as_py(), group.column("index").to_pylist()
        parts = [Fragment(h, c, t) for h, c, t in zip(*(group.column(k).to_pylist() for k in ("head", "closed", "tail")))]
        out, closed = parts[0], []
        for i, part in zip(index[1:], parts[1:]):
            out, text = compose(out, part)
            if text is not None:
                closed.append((2 * i * width - 1, text))
        if last:
            closed.append((-1, out.head))
            if out.closed:
                closed.append((2 * (index[-1] + 1) * width, out.tail[1:]))
        bodies = _aligner_here(a_file, b_file).bodies([t for _, t in closed]) if closed else []
        known = [(row, place, body) for (place, _), body in zip(closed, bodies)]
        batches = [_with_open([(row, 0, EMPTY)], pa.nulls(1, pa.int64()), [index[0] // FAN], [out])] if not last else []
        return pa.Table.from_batches([*batches, _with_open(known, pa.nulls(len(known), pa.int64()), [None] * len(known), [None] * len(known))])

    return fragments.groupBy("row", F.floor(F.col("index") / FAN).alias("_to")).applyInArrow(run, f"{BODY_DDL}, {OPEN_DDL}")


EMPTY = Body("", np.zeros(0, np.int64), 0, 0, True)
_HERE: dict[tuple[str, str], Aligner] = {}


def _aligner_here(a_file: str, b_file: str) -> Aligner:
    """One aligner a worker, for many small groups."""
    if (a_file, b_file) not in _HERE:
        _HERE[a_file, b_file] = _aligner(a_file, b_file)
    return _HERE[a_file, b_file]


def long_bodies(docs: DataFrame, size: int, a_file: str, b_file: str) -> tuple[DataFrame, DataFrame]:
    """row, doc_id of documents (row, doc_id, text), and BODY columns: their closed groups by place, from
    ranges that meet in a tree."""
    # ranges of one document go to many tasks
    leaves = level = cut(_leaves(_cut_up(docs, size).repartition("row", "index"), a_file, b_file))
    bodies, width = leaves.select(*BODY.names), 1
    ranges = (leaves.agg(F.max("index")).first()[0] or 0) + 1
    while True:
        last = ranges <= FAN
        level = cut(_meet(level.filter("index is not null").select("row", "index", "head", "closed", "tail"), width, last, a_file, b_file))
        bodies = bodies.unionByName(level.select(*BODY.names))
        if last:
            return leaves.filter("index = 0").select("row", "doc_id"), bodies.filter("groups <> '' or not whole")
        ranges, width = -(-ranges // FAN), width * FAN


def hashed(bodies: DataFrame) -> DataFrame:
    """row, n_a, n_b, n_groups, groups_sha256 of documents from their bodies, read in order as a stream."""
    schema = pa.schema([("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None  # row, hash, counts, whole

        def done() -> pa.RecordBatch:
            values = [now[0], *(now[2] if now[3] else (0, 0, 0)), now[1].hexdigest() if now[3] else ""]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for row, groups, n_links, n_a, n_b, whole in zip(*(batch.column(k).to_pylist() for k in ("row", "groups", "n_links", "n_a", "n_b", "whole"))):
                if now is None or row != now[0]:
                    if now:
                        yield done()
                    now = [row, hashlib.sha256(groups.encode()), (n_a, n_b, n_links), whole]
                else:
                    now[1].update(b";" + groups.encode())
                    now[2], now[3] = tuple(map(sum, zip(now[2], (n_a, n_b, n_links)))), now[3] and whole
        if now:
            yield done()

    ordered = bodies.select("row", "place", "groups", F.size("links").cast("long").alias("n_links"), "n_a", "n_b", "whole").repartition("row").sortWithinPartitions("row", "place")
    return ordered.mapInArrow(run, "row long, n_a long, n_b long, n_groups long, groups_sha256 string")


def align(docs: DataFrame, size: int = CHUNK, a_file: str = A_FILE, b_file: str = B_FILE) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id, n_a, n_b, n_groups, groups_sha256), and links (row, link) with link = a * SHIFT + b."""
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    is_long = F.coalesce(F.octet_length("text") > size, F.lit(False))
    # each side is read once, and keeps its rows' numbers from then on: even ones, and odd ones
    short = cut(short_documents(own.filter(~is_long).withColumn("row", 2 * F.col("row")), a_file, b_file))
    ids, bodies = long_bodies(own.filter(is_long).withColumn("row", 2 * F.col("row") + 1), size, a_file, b_file)
    long = cut(ids.join(hashed(bodies), "row"))
    known = short.drop("links").unionByName(long)
    from_long = bodies.join(long.filter("groups_sha256 <> ''").select("row"), "row", "left_semi")
    links = short.select("row", F.explode("links").alias("link")).unionByName(from_long.select("row", F.explode("links").alias("link")))
    return known, links


def pair_counts(links: DataFrame) -> DataFrame:
    """link, n, best: how often each id pair is linked, and whether no other A id is linked with its B id more often."""
    n = cut(links.groupBy("link").agg(F.count(F.lit(1)).alias("n")))
    top = n.groupBy((F.col("link") % SHIFT).alias("b")).agg(F.max("n").alias("top"))  # one row a B id
    return n.withColumn("b", F.col("link") % SHIFT).join(F.broadcast(top), "b").select("link", "n", (F.col("n") == F.col("top")).alias("best"))


def query(docs: DataFrame) -> DataFrame:
    """The registered digest over ``documents``."""
    known, links = align(docs)
    counted = links.join(F.broadcast(pair_counts(links)), "link")  # bounded by the vocabularies, see above
    sums = counted.groupBy("row").agg(F.count(F.lit(1)).alias("n_links"), F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return known.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
