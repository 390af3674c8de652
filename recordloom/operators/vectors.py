"""Vectors in array columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.sources.scratch import written

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def vector_search(df: DataFrame, key: str, vector: str, query: Sequence[float], k: int, where: Column | None = None) -> DataFrame:
    """The k rows nearest by cosine among those that pass the filter."""
    own = df.filter(where) if where is not None else df
    q = F.array(*[F.lit(float(x)) for x in query])
    cosine = dot(F.col(vector), q) / (norm(F.col(vector)) * norm(q))
    return own.select(key, F.round(cosine, 6).alias("cosine")).orderBy(F.desc("cosine"), key).limit(k)


def centroid_vec(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector of each key, of length one."""
    mean = df.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    out = mean.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("v"))
    return out.select(key, F.transform("v", lambda x: x / norm(F.col("v"))).alias(vector))


def cell_centres(df: DataFrame, vector: str, cells: int, seed: int = 7) -> np.ndarray:
    """Centres of coarse cells."""
    rows = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return np.array(KMeans(k=cells, seed=seed, maxIter=10).fit(rows).clusterCenters())


def ivf_assign(df: DataFrame, vector: str, centres: np.ndarray, probes: int = 1) -> DataFrame:
    """A row for each of the ``probes`` nearest cells, as ``cell``."""
    to = [F.struct((-dot(F.col(vector), F.array(*[F.lit(float(x)) for x in c])) + float(c @ c) / 2).alias("d"), F.lit(i).alias("cell")) for i, c in enumerate(centres)]
    near = F.slice(F.array_sort(F.array(*to)), F.lit(1), F.lit(probes))
    return df.withColumn("cell", F.explode(F.transform(near, lambda s: s["cell"])))


BLOCK_ROWS, ASKED_ROWS = 5_000, 1_000  # rows that are searched and that search in one group


def vector_match(a: DataFrame, a_key: str, b: DataFrame, b_key: str, vector: str, k: int, max_dist: float, incumbents: DataFrame | None = None, centres: np.ndarray | None = None) -> DataFrame:
    """The k nearest b-rows of each a-row under a cosine distance cap, incumbents removed.

    Every a-row meets every b-row, in groups of a block of each side; a group keeps what can still rank.
    With centres, both sides meet by cells instead, which keeps pairs whose b-cell is among the a-row's
    two nearest. Pairs without a distance (a null or zero vector, another length) have no part.
    """
    if centres is None:
        close = _close(a, a_key, b, b_key, vector, k, max_dist, incumbents)
    else:
        left, right = a.select(a_key, F.col(vector).alias("va")), b.select(b_key, F.col(vector).alias("vb"))
        met = ivf_assign(left, "va", centres, 2).join(ivf_assign(right, "vb", centres), "cell")
        distance = 1 - dot(F.col("va"), F.col("vb")) / (norm(F.col("va")) * norm(F.col("vb")))
        close = met.select(a_key, b_key, distance.alias("distance"))
        if incumbents is not None:
            close = close.join(incumbents, [a_key, b_key], "left_anti")
    close = close.withColumn("distance", F.round("distance", 6)).filter(F.col("distance") <= max_dist)
    w = Window.partitionBy(a_key).orderBy("distance", b_key)
    return close.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _close(a: DataFrame, a_key: str, b: DataFrame, b_key: str, vector: str, k: int, max_dist: float, incumbents: DataFrame | None) -> DataFrame:
    """a_key, b_key, distance: of each group of a block of both sides, the k nearest b-rows of each a-row, incumbents
    removed, and those so near to the k-th that rounding could put them before it; of equal distances the k least keys.

    Distances are found by one product of the blocks, then summed again for what is kept, in order.
    """
    kinds = {n: df.schema[n].dataType.simpleString() for n, df in ((a_key, a), (b_key, b))}
    own = lambda df, key, name: df.select(key, F.col(vector).cast("array<double>").alias(name)).filter(F.col(name).isNotNull())
    left, right = own(a, a_key, "va"), own(b, b_key, "vb")
    parts, blocks = max(1, -(-left.count() // ASKED_ROWS)), max(1, -(-right.count() // BLOCK_ROWS))
    if incumbents is not None:
        left = left.join(incumbents.groupBy(a_key).agg(F.collect_list(b_key).alias("known")), a_key, "left")
    else:
        left = left.withColumn("known", F.lit(None).cast(f"array<{kinds[b_key]}>"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = left.withColumn("part", F.pmod(F.xxhash64(a_key), F.lit(parts)).cast("int")).withColumn("block", every(blocks))
    given = right.withColumn("block", F.pmod(F.xxhash64(b_key), F.lit(blocks)).cast("int")).withColumn("part", every(parts))
    summed = lambda x, y: np.cumsum(x * y, axis=1)[:, -1]  # one after the other, as dot() does

    def meet(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({a_key: own[a_key][:0], b_key: rows[b_key][:0], "distance": np.zeros(0)})]
        sizes, others = own["va"].map(len).to_numpy(), rows["vb"].map(len).to_numpy()
        for width in set(sizes[sizes > 0].tolist()) & set(others.tolist()):
            asks, names = own[sizes == width], rows[b_key].to_numpy()[others == width]
            q, x = np.stack(asks["va"]).astype(float), np.stack(rows["vb"][others == width]).astype(float)
            with np.errstate(all="ignore"):
                lengths = np.sqrt(summed(q, q)), np.sqrt(summed(x, x))
                for i in range(0, len(q), 200):
                    d = 1 - q[i : i + 200] @ x.T / (lengths[0][i : i + 200, None] * lengths[1])
                    for at, known in enumerate(asks["known"][i : i + 200]):
                        if known is not None and len(known):
                            d[at, np.isin(names, known)] = np.inf
                    d[~np.isfinite(d)] = np.inf
                    limit = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] > k else np.full(len(d), np.inf)
                    r, s = np.nonzero((d <= np.minimum(limit, max_dist)[:, None] + 2e-6) & (d < np.inf))
                    exact = 1 - summed(q[i + r], x[s]) / (lengths[0][i + r] * lengths[1][s])
                    kept = pd.DataFrame({a_key: asks[a_key].to_numpy()[i + r], b_key: names[s], "distance": exact, "row": r})
                    out.append(kept.sort_values(b_key).groupby(["row", "distance"]).head(k).drop(columns="row"))
        return pd.concat([x for x in out if len(x)] or out)

    met = asked.groupBy("part", "block").cogroup(given.groupBy("part", "block"))
    return met.applyInPandas(meet, f"{a_key} {kinds[a_key]}, {b_key} {kinds[b_key]}, distance double")


def ivf_search(queries: DataFrame, q_key: str, df: DataFrame, key: str, vector: str, centres: np.ndarray, probes: int, k: int) -> DataFrame:
    """The k rows nearest by cosine to each query among those in its ``probes`` nearest cells."""
    own = ivf_assign(queries.select(q_key, F.col(vector).alias("va")), "va", centres, probes)
    met = own.join(ivf_assign(df.select(key, F.col(vector).alias("vb")), "vb", centres), "cell")
    distance = F.round(1 - dot(F.col("va"), F.col("vb")) / (norm(F.col("va")) * norm(F.col("vb"))), 6)
    w = Window.partitionBy(q_key).orderBy("distance", key)
    return met.select(q_key, key, distance.alias("distance")).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


SAMPLE = 20_000  # vectors that codebooks are fitted on, at most
CODE_BLOCK, QUERY_BLOCK = 50_000, 2_000  # codes and queries that meet in one group


def codebooks(df: DataFrame, vector: str, parts: int, codes: int = 256, sample: int = SAMPLE, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """(parts, codes, width): centres of each part of the unit vectors, fitted on a bounded sample of rows."""
    share = min(1.0, 1.2 * sample / max(df.count(), 1))
    rows = df.select(vector).filter(F.rand(seed) < share).limit(sample).toPandas()[vector]
    x = np.stack(rows.to_list()).astype(np.float64)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    if x.shape[1] % parts:
        raise ValueError(f"vectors of {x.shape[1]} do not fall into {parts} equal parts")
    random, out = np.random.default_rng(seed), []
    for own in np.split(x, parts, axis=1):
        centres = own[random.choice(len(own), codes, replace=len(own) < codes)]
        for _ in range(rounds):
            near = np.argmin((centres**2).sum(1) / 2 - own @ centres.T, axis=1)
            total = np.stack([np.bincount(near, own[:, i], codes) for i in range(own.shape[1])], axis=1)
            n = np.bincount(near, minlength=codes)[:, None]
            centres = np.where(n > 0, total / np.maximum(n, 1), centres)
        out.append(centres)
    return np.stack(out)


def pq_encode(df: DataFrame, key: str, vector: str, centres: np.ndarray, books: np.ndarray) -> DataFrame:
    """key, cell, code: each row's coarse cell and one byte for each part of its unit vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch[vector].to_list()).astype(np.float64)
                cell = np.argmin((centres**2).sum(1) / 2 - x @ centres.T, axis=1)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                near = [np.argmin((b**2).sum(1) / 2 - own @ b.T, axis=1) for own, b in zip(np.split(x, len(books), axis=1), books)]
                code = np.stack(near, axis=1).astype(np.uint8)
                yield pd.DataFrame({key: batch[key], "cell": cell, "code": [c.tobytes() for c in code]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, vector).filter(F.col(vector).isNotNull()).mapInPandas(run, f"{key} {kind}, cell int, code binary")


def pq_candidates(queries: DataFrame, q_key: str, codes: DataFrame, key: str, vector: str, centres: np.ndarray, books: np.ndarray, probes: int, shortlist: int) -> DataFrame:
    """q_key, key, near: the rows whose codes lie nearest to each query, ``shortlist`` of them.

    Codes of a cell and the queries that probe it meet in blocks of bounded size, each of which keeps its own shortlist.
    """
    sizes = codes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CODE_BLOCK).cast("int").alias("blocks"))  # a row a cell
    dealt = codes.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")).drop("blocks")
    groups = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = ivf_assign(queries.select(q_key, F.col(vector).alias("va")), "va", centres, probes).withColumn("part", F.pmod(F.xxhash64(q_key), F.lit(groups)).cast("int"))
    asked = asked.join(F.broadcast(sizes), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))) if groups > 1 else dealt.withColumn("part", F.lit(0))

    def meet(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(rows):
            code = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
            names = rows[key].to_numpy()
            for q, v in zip(own[q_key], own["va"]):
                v = np.asarray(v, np.float64)
                table = np.einsum("pcw,pw->pc", books, v.reshape(len(books), -1)) / max(np.linalg.norm(v), 1e-12)
                near = table[np.arange(len(books))[None, :], code].sum(1)
                best = np.argpartition(-near, min(shortlist, len(near)) - 1)[:shortlist]
                out.append(pd.DataFrame({q_key: q, key: names[best], "near": near[best]}))
        return pd.concat(out) if out else pd.DataFrame({q_key: [], key: [], "near": []})

    kinds = {n: df.schema[n].dataType.simpleString() for n, df in ((q_key, queries), (key, codes))}
    met = asked.groupBy("cell", "block", "part").cogroup(dealt.groupBy("cell", "block", "part")).applyInPandas(meet, f"{q_key} {kinds[q_key]}, {key} {kinds[key]}, near double")
    w = Window.partitionBy(q_key).orderBy(F.desc("near"), key)
    return met.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= shortlist).drop("_rn")


def pq_search(queries: DataFrame, q_key: str, df: DataFrame, key: str, vector: str, centres: np.ndarray, books: np.ndarray, probes: int, k: int, shortlist: int) -> DataFrame:
    """The k rows nearest by cosine to each query (V04): codes of ``probes`` cells give a shortlist, whose vectors
    alone are compared whole."""
    codes = written(pq_encode(df, key, vector, centres, books))
    near = pq_candidates(queries, q_key, codes, key, vector, centres, books, probes, shortlist)
    met = near.join(df.select(key, F.col(vector).alias("vb")), key).join(queries.select(q_key, F.col(vector).alias("va")), q_key)
    distance = F.round(1 - dot(F.col("va"), F.col("vb")) / (norm(F.col("va")) * norm(F.col("vb"))), 6)
    w = Window.partitionBy(q_key).orderBy("distance", key)
    return met.select(q_key, key, distance.alias("distance")).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def embed(df: DataFrame, key: str, text: str, vector: str, fn: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """Vectors for the rows that have none (V05); fn maps a list of texts to a matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], vector: list(fn(batch[text].fillna("").tolist()).astype(np.float32))})

    kind = df.schema[key].dataType.simpleString()
    return df.filter(F.col(vector).isNull()).select(key, text).mapInPandas(run, f"{key} {kind}, {vector} array<float>")


BUCKETS, WIDTH, EXTRA = 1 << 16, 64, 16  # hashed words, dimensions, further ones of the random test matrix


def _weighed(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, weight) of each different word of texts: (1 + log n) x weight, of length one a text."""
    words = [text.lower().split() for text in texts]
    row = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    bucket = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % len(weights) for own in words for w in own), np.int64, len(row))
    cell, n = np.unique(row * len(weights) + bucket, return_counts=True)
    row, bucket = cell // len(weights), cell % len(weights)
    weight = (1 + np.log(n)) * weights[bucket]
    length = np.sqrt(np.bincount(row, weight**2, len(texts)))
    return row, bucket, weight / np.maximum(length[row], 1e-12)


def _short(texts: list[str], limit: int = 1 << 18) -> Iterator[list[str]]:
    """Texts in lists of about limit characters, one text at least."""
    own, size = [], 0
    for text in texts:
        if own and size + len(text) > limit:
            yield own
            own, size = [], 0
        own.append(text)
        size += len(text)
    if own:
        yield own


def word_weights(df: DataFrame, text: str, buckets: int = BUCKETS) -> np.ndarray:
    """log(rows / rows that hold it) of each hashed word, 0 for words that no row holds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for own in _short(batch[text].fillna("").tolist()):
                n += np.bincount(_weighed(own, np.ones(buckets))[1], minlength=buckets)
        held = np.flatnonzero(n)
        yield pd.DataFrame({"bucket": held, "n": n[held]})

    rows = df.count()
    held = df.select(text).mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most ``buckets`` rows
    out = np.zeros(buckets)
    out[held["bucket"]] = np.log((rows + 1) / held["n"])
    return out


def word_vectors(df: DataFrame, text: str, width: int = WIDTH, buckets: int = BUCKETS, passes: int = 2, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and vectors of hashed words, learned from all rows' texts.

    A randomised singular value decomposition of the weighted (text x word) matrix A: each pass projects its
    rows on a matrix R, at first a random one, and every task adds up its share of A'AR; what all of them
    come to, words by width, is orthogonalised and is the next R. A'A counts which words occur together,
    so words of one company get vectors of one direction. What reaches the driver is of one size
    whatever the rows.
    """
    weights = word_weights(df, text, buckets)
    basis = (np.random.default_rng(seed).integers(0, 2, (buckets, width + EXTRA), np.int8) * 2 - 1).astype(np.float32)
    for _ in range(passes):
        basis, size, _ = np.linalg.svd(_projected(df, text, weights, basis).astype(np.float64), full_matrices=False)
        basis = (basis * (size > size[0] * 1e-6)).astype(np.float32)
    return weights, basis[:, :width]


def _projected(df: DataFrame, text: str, weights: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """A'A times a matrix of words by width."""
    blocks = 64
    shared = df.sparkSession.sparkContext.broadcast((weights, signs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, signs = shared.value
        total, seen = np.zeros(signs.shape, np.float32), False
        for batch in batches:
            for own in _short(batch[text].fillna("").tolist()):
                row, bucket, weight = _weighed(own, weights)
                if len(row):
                    seen = True
                    first = np.flatnonzero(np.diff(row, prepend=-1))
                    y = np.zeros((len(own), signs.shape[1]), np.float32)
                    y[row[first]] = np.add.reduceat(signs[bucket] * weight[:, None].astype(np.float32), first)
                    order = np.argsort(bucket, kind="stable")
                    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                    total[bucket[order][first]] += np.add.reduceat(y[row[order]] * weight[order, None].astype(np.float32), first)
        if seen:
            salt = np.random.default_rng().integers(32)  # only deals sums to tasks
            for i, part in enumerate(np.split(total, blocks)):
                yield pd.DataFrame({"block": [i], "salt": [int(salt)], "sums": [part.tobytes()]})

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(x, np.float32) for x in rows["sums"])
        return pd.DataFrame({"block": rows["block"].iloc[:1], "salt": [0], "sums": [sums.astype(np.float32).tobytes()]})

    kind = "block int, salt int, sums binary"
    parts = df.select(text).mapInPandas(run, kind).groupBy("block", "salt").applyInPandas(added, kind).groupBy("block").applyInPandas(added, kind)
    whole = np.zeros((blocks, signs.size // blocks), np.float32)
    for r in parts.toLocalIterator():  # ``blocks`` rows of one size
        whole[r.block] = np.frombuffer(r.sums, np.float32)
    return whole.reshape(signs.shape)


def word_model(spark: SparkSession, weights: np.ndarray, vectors: np.ndarray) -> Callable[[list[str]], np.ndarray]:
    """Unit vectors of texts for ``embed``: the weighted sum of their words' vectors; zeros for texts without known words."""
    shared = spark.sparkContext.broadcast((weights, vectors.astype(np.float32)))

    def model(texts: list[str]) -> np.ndarray:
        weights, vectors = shared.value
        out, at = np.zeros((len(texts), vectors.shape[1])), 0
        for own in _short(texts):
            row, bucket, weight = _weighed(own, weights)
            for i in range(vectors.shape[1]):
                out[at : at + len(own), i] = np.bincount(row, weight * vectors[bucket, i], len(own))
            at += len(own)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return model


def hashed_words(texts: list[str], width: int = 64) -> np.ndarray:
    """Bag of words hashed into a unit vector, without anything learned: what a model has to beat."""
    out = np.zeros((len(texts), width))
    for row, text in zip(out, texts):
        for word in text.lower().split():
            row[zlib.crc32(word.encode()) % width] += 1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1)
