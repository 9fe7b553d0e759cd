"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words (longer ones when the
document would have more than ``MOST_PASSAGES``, so no text is left out). Every
passage is described by character classes, word lengths, repetition and hashed
words, and encoded by a small network. Gated attention gives each passage a
weight, and the score is read from the weighted sum of the encodings. Only
document labels are needed: the attention learns which passages matter.

The model is fitted on at most ``PER_CLASS`` labelled documents of each class,
those of least hash, outside the held-out third. This bound is the only one;
every document is scored whole. The class shares of all labels outside the
held-out third correct the score for the balanced sample.

Defined results: null and empty texts are one passage without words and get a
score like any other; labels that are null, repeated with one value or of
unknown documents are used once, ignored, or without effect; a doc_id with
both labels counts in both classes; without labels of both classes the score
is the share of label 1, or 0.5 without any label; repeated rows give repeated
results; a null doc_id is not held out; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import Chunk, bound_batches, mix, slices, text_bytes

PASSAGE, MOST_PASSAGES = 64, 64
#: Labelled documents of each class that the model is fitted on, at most.
PER_CLASS = 1500
HASHED = 48
HIDDEN, GATE = 24, 16
EPOCHS, BATCH, RATE, DECAY = 40, 128, 0.01, 1e-4

# Byte classes that describe the look of a passage.
_CLASSES = (bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), b".,;:", b"!?", b"#*$%&<>", b"|",
            b"'\"()[]{}-_/", b"\n", b"\\^~`=+@", bytes(range(128, 256)))
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _chars in enumerate(_CLASSES):
    _CLASS[list(_chars)] = _i
_LOOK = len(_CLASSES) + 1
#: Looks, four measures of words, length of the passage, hashed words.
WIDTH = _LOOK + 5 + HASHED


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row per passage, and the number of passages of each text."""
    chunk = Chunk(texts)
    n = np.diff(chunk.word_at)
    size = np.maximum(PASSAGE, -(-n // MOST_PASSAGES))
    bags = np.maximum(1, -(-n // size))
    base = np.cumsum(bags) - bags
    total = int(bags.sum())
    inside = np.arange(len(chunk.doc)) - chunk.word_at[chunk.doc]
    passage = base[chunk.doc] + inside // size[chunk.doc]
    words = np.bincount(passage, minlength=total).astype(np.float64)
    out = np.zeros((total, WIDTH))
    # A byte belongs to the passage of the last word that began before it.
    word = np.searchsorted(chunk.first, np.arange(len(chunk.data)), side="right") - 1
    doc = np.searchsorted(chunk.doc_at, np.arange(len(chunk.data)), side="right") - 1
    of = np.where((word >= 0) & (word >= chunk.word_at[doc]), passage[np.maximum(word, 0)] if len(passage) else 0, base[doc]) \
        if len(chunk.data) else np.zeros(0, np.int64)
    looks = np.bincount(of * _LOOK + _CLASS[chunk.data], minlength=total * _LOOK).reshape(total, _LOOK)
    out[:, :_LOOK] = looks / np.maximum(1, looks.sum(axis=1, keepdims=True))
    per = np.maximum(1, words)
    if len(passage):
        hashes = chunk.word_hashes()
        length = (chunk.end - chunk.first).astype(np.float64)
        out[:, _LOOK] = np.bincount(passage, length, total) / per / 10
        out[:, _LOOK + 1] = np.bincount(passage, length <= 3, total) / per
        out[:, _LOOK + 2] = _repeated(hashes, chunk.doc, passage, total) / per
        start, runs = chunk.windows(hashes, 4)
        out[:, _LOOK + 3] = _repeated(runs, chunk.doc[start], passage[start], total) / per
        slot = (hashes >> np.uint64(40)).astype(np.int64) % HASHED
        counts = np.bincount(passage * HASHED + slot, minlength=total * HASHED).reshape(total, HASHED)
        out[:, _LOOK + 5:] = np.sqrt(counts / per[:, None])
    out[:, _LOOK + 4] = np.log1p(words) / 5
    return out.astype(np.float32), bags


def _repeated(keys: np.ndarray, owner: np.ndarray, passage: np.ndarray, total: int) -> np.ndarray:
    """Per passage, the keys that occur more than once in their document."""
    own = mix(keys ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own, kind="stable")
    again = np.zeros(len(own), bool)
    same = own[order][1:] == own[order][:-1]
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return np.bincount(passage, again, total)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    shift: float

    def logits(self, rows: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(bags), self.shift)
        return _forward(self.weights, (rows - self.mean) / self.scale, bags)["out"] + self.shift

    def score(self, texts: list[bytes]) -> np.ndarray:
        rows, bags = features(texts)
        return 1 / (1 + np.exp(-np.clip(self.logits(rows, bags), -40, 40)))

    def attention(self, text: bytes) -> np.ndarray:
        """Weights of the passages of one text; they add up to 1."""
        rows, bags = features([text])
        if not self.weights:
            return np.full(len(rows), 1 / len(rows))
        return _forward(self.weights, (rows - self.mean) / self.scale, bags)["a"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
    at = np.cumsum(bags) - bags
    h = np.tanh(x @ w["E"] + w["e"])
    t = np.tanh(h @ w["V"])
    s = 1 / (1 + np.exp(-np.clip(h @ w["U"], -40, 40)))
    raw = (t * s) @ w["k"]
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, at), bags))
    a = raw / np.repeat(np.add.reduceat(raw, at), bags)
    z = np.add.reduceat(a[:, None] * h, at)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "out": z @ w["c"] + w["d"]}


def _gradient(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean logistic loss."""
    f = _forward(w, x, bags)
    h, t, s, a = f["h"], f["t"], f["s"], f["a"]
    at = np.cumsum(bags) - bags
    err = (1 / (1 + np.exp(-np.clip(f["out"], -40, 40))) - y) / len(y)
    dz = np.repeat(err[:, None] * w["c"], bags, axis=0)
    da = (dz * h).sum(axis=1)
    draw = a * (da - np.repeat(np.add.reduceat(a * da, at), bags))
    dt, ds = draw[:, None] * s * w["k"] * (1 - t * t), draw[:, None] * t * w["k"] * s * (1 - s)
    dh = (a[:, None] * dz + dt @ w["V"].T + ds @ w["U"].T) * (1 - h * h)
    return {"E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "k": (t * s).T @ draw,
            "c": f["z"].T @ err, "d": np.array(err.sum())}


def fit(rows: list[np.ndarray], labels: np.ndarray, shares: tuple[int, int]) -> Model:
    """Fit on bags of passages. ``shares`` are the counts of labels 0 and 1 among all training labels."""
    zeros, ones = shares
    known = np.log(ones / zeros) if ones and zeros else (0.0 if ones == zeros else np.sign(ones - zeros) * 40.0)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(WIDTH), np.ones(WIDTH), {}, float(known))
    every = np.concatenate(rows).astype(np.float64)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    bags = [(r - mean) / scale for r in rows]
    rng = np.random.default_rng(7)
    w = {"E": rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)), "e": np.zeros(HIDDEN),
         "V": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)), "U": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
         "k": rng.normal(0, 1 / np.sqrt(GATE), GATE), "c": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "d": np.zeros(())}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            grads = _gradient(w, np.concatenate([bags[i] for i in some]),
                              np.array([len(bags[i]) for i in some]), labels[some])
            step += 1
            for k, g in grads.items():
                g = g + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = RATE * (1 - epoch / EPOCHS) + 1e-4
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    sampled = np.log(labels.sum() / (len(labels) - labels.sum()))
    return Model(mean, scale, w, float(known - sampled))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Passage features of the sampled documents: doc_id, quality, rows (float32 bytes)."""
    known = labels.filter(~held_out()).filter("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality").distinct()
    # Both sides stay within PER_CLASS rows.
    picked = None
    for value in (0, 1):
        some = (known.filter(F.col("quality") == value).withColumn("order", F.xxhash64("doc_id"))
                .orderBy("order", "doc_id").limit(PER_CLASS).drop("order"))
        picked = some if picked is None else picked.unionByName(some)
    bag = F.pandas_udf(_bag_batch, "binary")
    return (bound_batches(docs).select("doc_id", text_bytes().alias("text")).join(F.broadcast(picked), "doc_id")
            .select("doc_id", "quality", bag("text").alias("rows"))
            # A doc_id may have many rows; one of them counts, and one row a label reaches the driver.
            .groupBy("doc_id", "quality").agg(F.min("rows").alias("rows")))


def _bag_batch(texts: pd.Series) -> pd.Series:
    out: list[bytes] = []
    whole = texts.tolist()
    for lo, hi in slices(whole):
        rows, bags = features(whole[lo:hi])
        at = np.concatenate([[0], np.cumsum(bags)])
        out += [rows[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
    return pd.Series(out, dtype=object)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample; at most 2 * PER_CLASS bags of MOST_PASSAGES rows reach the driver."""
    rows = sorted(training_sample(docs, labels).collect(), key=lambda r: (r.doc_id, r.quality, r.rows))
    counts = {r.quality: r["count"] for r in labels.filter(~held_out()).filter("quality IN (0, 1)")
              .select("doc_id", "quality").distinct().groupBy("quality").count().collect()}
    bags = [np.frombuffer(r.rows, np.float32).reshape(-1, WIDTH) for r in rows]
    return fit(bags, np.array([r.quality for r in rows], np.float64), (counts.get(0, 0), counts.get(1, 0)))


def scored(text: Column, model: Model) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        whole = texts.tolist()
        parts = [model.score(whole[lo:hi]) for lo, hi in slices(whole)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return F.pandas_udf(run, "double")(text)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted label of every document; no shuffle."""
    return (bound_batches(docs).select("doc_id", held_out().alias("held_out"), scored(text_bytes(), model).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))
