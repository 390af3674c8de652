"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes; every passage of every text is encoded, none
is dropped. A passage's features are the square roots of its shares of character-class pairs, with
its length and, from its document, the shares of distinct words and lines. One tanh layer encodes
it; gated attention (tanh times sigmoid) weighs the passages of a bag; the weighted sum is scored by
a logistic output. All weights are learned together, by Adam in numpy, from document labels alone.

Training takes at most ``SAMPLE`` labelled documents, in the order of a hash of their ids and as long as
their texts sum to at most ``BYTES``, each with all its passages, whatever its length: that bounds what
reaches the driver. Scoring takes all documents and all passages in tasks. Documents whose crc32(doc_id) mod 3 is 1 are never trained on.

Defined results: a null text counts as empty and is scored like one (one passage of no characters);
null ids are not held out and never trained on; conflicting labels of one id count as 1 if at least
half of them are 1; of several texts of one id the least is trained on; repeated rows each give
their row; with no usable labels of either class every
score is the share of label 1 (0.5 if there are none); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import slices

PASSAGE = 512
SAMPLE, BYTES = 4000, 64 << 20  # documents that training gathers, and bytes of their texts, at most
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE = 20, 64, 0.004
EXTRA = 5


def _classes() -> np.ndarray:
    """Class of each byte value: 16 kinds of characters."""
    out = np.zeros(256, np.int64)
    groups = ["\n", " ", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOUBCDFGHJKLMNPQRSTVWXYZ", "0123456789", ".", ",;:", "!?", "#$%&*@^~", "|_=+-<>/\\", "\"'()[]{}`", "\t"]
    for number, group in enumerate(groups, 1):
        out[list(group.encode())] = number
    out[0x80:0xC0], out[0xC0:] = 14, 15
    return out


CLASS = _classes()
WIDTH = 256 + EXTRA


def bag(text: str) -> np.ndarray:
    """Features [passage, WIDTH] of a text."""
    kinds = CLASS[np.frombuffer(text.encode("utf-8"), np.uint8)]
    count = max(1, -(-len(kinds) // PASSAGE))
    pair = kinds[:-1] * 16 + kinds[1:] if len(kinds) > 1 else kinds[:0]
    place = np.arange(len(pair)) // PASSAGE
    place = np.minimum(place, count - 1)
    hist = np.bincount(place * 256 + pair, minlength=count * 256).reshape(count, 256)
    size = hist.sum(axis=1)
    words, lines = text.split(), text.split("\n")
    out = np.empty((count, WIDTH), np.float32)
    out[:, :256] = np.sqrt(hist / np.maximum(size, 1)[:, None])
    out[:, 256] = np.log1p(size) / 6
    out[:, 257] = len(set(words)) / max(len(words), 1)
    out[:, 258] = len(set(lines)) / len(lines)
    out[:, 259] = np.log1p(len(words)) / 10
    out[:, 260] = len(text) / max(len(words), 1) / 20 if words else 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def forward(p: dict, x: np.ndarray, begins: np.ndarray) -> dict:
    """Scores of the bags that begin at rows ``begins`` of x, with what the gradient needs."""
    x = (x - p["mean"]) / p["scale"]
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    sizes = np.diff(np.append(begins, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), sizes))
    a = e / np.repeat(np.add.reduceat(e, begins), sizes)
    z = np.add.reduceat(a[:, None] * h, begins)
    return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "y": _sigmoid(z @ p["o"] + p["c"])}


def gradient(p: dict, f: dict, labels: np.ndarray, begins: np.ndarray) -> dict:
    d = (f["y"] - labels) / len(labels)
    dz = np.repeat(d[:, None] * p["o"], f["sizes"], axis=0)
    da = (dz * f["h"]).sum(axis=1)
    de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, begins), f["sizes"]))
    dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
    dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
    dh *= 1 - f["h"] ** 2
    return {"o": f["z"].T @ d, "c": d.sum(), "w": (f["t"] * f["g"]).T @ de, "V": f["h"].T @ dt, "U": f["h"].T @ dg, "W": f["x"].T @ dh + 1e-5 * p["W"], "b": dh.sum(axis=0)}


def train(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> dict:
    """Weights of the model; a constant score if one class is missing."""
    if not len(labels) or labels.min() == labels.max():
        return {"constant": float(labels.mean()) if len(labels) else 0.5}
    r = np.random.default_rng(seed)
    every = np.concatenate(bags)
    p = {"mean": every.mean(axis=0), "scale": every.std(axis=0) + 0.02}
    shape = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "o": (HIDDEN,), "c": ()}
    for k, s in shape.items():
        p[k] = r.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32) if s else np.float32(0)
    m, v = {k: np.zeros_like(p[k]) for k in shape}, {k: np.zeros_like(p[k]) for k in shape}
    step = 0
    for epoch in range(EPOCHS):
        order = r.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            own = order[i : i + BATCH]
            x = np.concatenate([bags[j] for j in own])
            begins = np.cumsum([0] + [len(bags[j]) for j in own])[:-1]
            grad = gradient(p, forward(p, x, begins), labels[own], begins)
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            for k, g in grad.items():
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - np.float32(rate) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p


def score_texts(p: dict, texts: list[str]) -> np.ndarray:
    if "constant" in p:
        return np.full(len(texts), p["constant"])
    bags = [bag(t) for t in texts]
    return forward(p, np.concatenate(bags), np.cumsum([0] + [len(b) for b in bags])[:-1])["y"].astype(np.float64)


def remainder(doc_id: Column, n: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Train on at most sample labelled documents outside the held-out third, in the order of a hash of their
    ids, as long as their texts sum to at most BYTES."""
    one = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("_label"))
    usable = one.filter(remainder(F.col("_id"), 3) != 1)
    own = usable.orderBy(F.xxhash64("_id"), "_id").limit(sample)  # the bound of what is broadcast and gathered

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"_id": batch["_id"], "_label": batch["_label"], "bag": [bag(t).astype(np.float16).tobytes() for t in batch["text"]]})

    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(own), "_id")
    sizes = texts.groupBy("_id").agg(F.max(F.octet_length("text")).alias("_size"))  # at most sample rows
    upto = F.sum("_size").over(Window.orderBy(F.xxhash64("_id"), "_id"))
    taken = sizes.withColumn("_upto", upto).filter(F.col("_upto") <= BYTES).select("_id")
    one_text = texts.join(F.broadcast(taken), "_id").groupBy("_id", "_label").agg(F.min("text").alias("text"))
    seen = one_text.mapInPandas(encode, "_id long, _label int, bag binary").orderBy("_id").toPandas()
    bags = [np.frombuffer(b, np.float16).reshape(-1, WIDTH).astype(np.float32) for b in seen["bag"]]
    return train(bags, seen["_label"].to_numpy(np.float64))


def scorer(model: dict) -> Callable[[Column | str], Column]:
    """A column function: the score of a text between 0 and 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.fillna("").tolist()
            yield pd.Series(np.concatenate([score_texts(model, texts[a:b]) for a, b in slices(texts, 1 << 20)] or [np.zeros(0)]))

    return run


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs that the classifier accepts, with all their columns and no other."""
    return docs.filter(scorer(fit(docs, labels))("text") >= threshold)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered digest: held_out, score and prediction of every document."""
    out = docs.select("doc_id", scorer(fit(docs, labels))("text").alias("score"))
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
