"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of 64 words; every word is in one). Each passage is
encoded from its own features, gated attention learns from document labels alone which
passages matter, and the document's score is the logistic output on the attention-weighted
mean of its passage codes. Training takes a bounded sample of labelled documents; scoring is
map-only and takes whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import text_slices

PASSAGE = 64               # words a passage
HASHED = 32                # buckets of word hashes
MAX_TRAIN = 4000           # labelled documents the model is fitted on
KEEP = 0.7

_LOWER, _UPPER, _DIGIT, _SPACE, _BREAK, _STOP, _COMMA, _CALL, _SIGN, _BAR, _OTHER, _HIGH = range(12)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = _LOWER
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[[32, 9, 11, 12, 13]] = _SPACE
_CLASS[10] = _BREAK
_CLASS[[ord("."), ord(":"), ord(";")]] = _STOP
_CLASS[ord(",")] = _COMMA
_CLASS[[ord("!"), ord("?")]] = _CALL
_CLASS[[ord(c) for c in "#$%&*@^~=+"]] = _SIGN
_CLASS[[ord(c) for c in "|<>{}[]\\/_"]] = _BAR
_CLASS[128:] = _HIGH
WIDTH = 12 + 5 + HASHED
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, _BASE, np.uint64))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (float32) and each passage's document number. A text without words has
    one passage of zeros."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    cls = _CLASS[data]
    white = (cls == _SPACE) | (cls == _BREAK)
    edge = np.flatnonzero(np.diff(np.r_[True, white].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]                    # the data ends in white space, so edges pair up
    doc_end = np.cumsum(sizes)
    word_doc = np.searchsorted(doc_end, starts, "right")
    words = np.bincount(word_doc, minlength=len(texts))
    first_word = np.cumsum(words) - words
    per_doc = np.maximum(1, -(-words // PASSAGE))
    first_passage = np.cumsum(per_doc) - per_doc
    doc_of = np.repeat(np.arange(len(texts)), per_doc)
    out = np.zeros((len(doc_of), WIDTH), np.float32)
    if not len(starts):
        return out, doc_of
    passage = first_passage[word_doc] + (np.arange(len(starts)) - first_word[word_doc]) // PASSAGE
    n_words = np.bincount(passage, minlength=len(out))
    some = np.maximum(n_words, 1)
    # a passage's bytes run from its first word to the next passage's first word or the document's end
    begin = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    cut = np.unique(np.r_[starts[begin], np.cumsum(sizes) - sizes, len(data)])
    owner = np.full(len(cut) - 1, -1)
    owner[np.searchsorted(cut, starts[begin])] = passage[begin]
    span = np.diff(cut)
    counts = np.bincount(np.repeat(np.arange(len(span)) * 12, span) + cls, minlength=12 * len(span)).reshape(-1, 12)
    out[owner[owner >= 0], :12] = (counts / span[:, None])[owner >= 0]
    # word hashes: bytes times powers of their place in the word
    inside = np.flatnonzero(~white)
    place = inside - np.repeat(starts, ends - starts)
    h = np.add.reduceat(data[inside].astype(np.uint64) * _POWERS[np.minimum(place, 63)],
                        np.cumsum(ends - starts) - (ends - starts))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    at = 12
    out[:, at] = np.bincount(passage, ends - starts, len(out)) / some / 8
    out[:, at + 1] = np.log1p(n_words) / 4
    out[:, at + 2] = np.bincount(passage, ~_repeated(passage, h), len(out)) / some
    same = np.r_[False, (h[1:] == h[:-1]) & (word_doc[1:] == word_doc[:-1])]
    out[:, at + 3] = np.bincount(passage, same, len(out)) / some
    # words whose trigram came before in the document
    tri = h.copy()
    tri[:-1] += h[1:] * np.uint64(3)
    tri[:-2] += h[2:] * np.uint64(7)
    seen = _repeated(word_doc, tri)
    seen &= np.arange(len(h)) < (first_word + words - 2)[word_doc]
    out[:, at + 4] = np.bincount(passage, seen, len(out)) / some
    buckets = np.bincount(passage * HASHED + (h >> np.uint64(59)).astype(np.int64), minlength=len(out) * HASHED)
    out[:, at + 5:] = np.sqrt(buckets.reshape(-1, HASHED) / some[:, None])
    return out, doc_of


def _mixed(group: np.ndarray, h: np.ndarray) -> np.ndarray:
    return h ^ (group.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def _repeated(group: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the group had the same hash at an earlier place."""
    key = _mixed(group, h)
    order = np.argsort(key, kind="stable")
    key = key[order]
    out = np.zeros(len(h), bool)
    out[order[1:]] = key[1:] == key[:-1]
    return out


@dataclass
class Model:
    """Weights: feature scaling, encoder, gated attention, output."""
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    bias: float

    def score(self, x: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
        return _forward((self.w, self.b, self.v, self.u, self.a, self.c, np.float64(self.bias)),
                        (x - self.mean) / self.scale, doc_of)[0]


def _forward(weights, x, doc_of):
    w, b, v, u, a, c, bias = weights
    h = np.tanh(x @ w + b)
    t, g = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
    e = (t * g) @ a
    start = np.flatnonzero(np.r_[True, doc_of[1:] != doc_of[:-1]])
    e = np.exp(e - np.maximum.reduceat(e, start)[doc_of])
    alpha = e / np.add.reduceat(e, start)[doc_of]
    z = np.add.reduceat(alpha[:, None] * h, start)
    p = 1 / (1 + np.exp(-np.clip(z @ c + bias, -30, 30)))
    return p, h, t, g, alpha, z


def _gradients(weights, x: np.ndarray, doc_of: np.ndarray, y: np.ndarray) -> list:
    """Gradients of the mean log loss over the documents."""
    w, b, v, u, a, c, bias = weights
    p, h, t, g, alpha, z = _forward(weights, x, doc_of)
    dz_out = (p - y) / len(y)
    dz = dz_out[:, None] * c
    dalpha = (dz[doc_of] * h).sum(axis=1)
    mid = np.bincount(doc_of, alpha * dalpha, len(y))
    de = alpha * (dalpha - mid[doc_of])
    dt, dg = de[:, None] * a * g * (1 - t ** 2), de[:, None] * a * t * g * (1 - g)
    dh = (alpha[:, None] * dz[doc_of] + dt @ v.T + dg @ u.T) * (1 - h ** 2)
    return [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ dg, (t * g).T @ de, z.T @ dz_out, dz_out.sum()]


def fit(x: np.ndarray, doc_of: np.ndarray, y: np.ndarray, hidden: int = 16, gate: int = 8, steps: int = 800,
        batch: int = 256, rate: float = 0.01, decay: float = 1e-3, seed: int = 7) -> Model:
    """Adam on the log loss of document labels. ``doc_of`` runs 0, 0, .., 1, .. without gaps."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = ((x - mean) / scale).astype(np.float64)
    d = x.shape[1]
    weights = [rng.normal(0, d ** -0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, 0.3, (hidden, gate)),
               rng.normal(0, 0.3, (hidden, gate)), rng.normal(0, 0.3, gate), rng.normal(0, 0.3, hidden), np.float64(0)]
    m1, m2 = [0 * p for p in weights], [0 * p for p in weights]
    starts = np.searchsorted(doc_of, np.arange(len(y)))
    counts = np.diff(np.r_[starts, len(doc_of)])
    step = 0
    while step < steps:
        order = rng.permutation(len(y))
        for pick in (order[i:i + batch] for i in range(0, len(order), batch)):
            n = counts[pick]
            of = np.repeat(np.arange(len(pick)), n)
            rows = np.repeat(starts[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            xb = x[rows]
            grads = _gradients(weights, xb, of, y[pick])
            step += 1
            for i, grad in enumerate(grads):
                grad = grad + decay * weights[i]
                m1[i] = 0.9 * m1[i] + 0.1 * grad
                m2[i] = 0.999 * m2[i] + 0.001 * grad ** 2
                weights[i] = weights[i] - rate * (m1[i] / (1 - 0.9 ** step)) / (np.sqrt(m2[i] / (1 - 0.999 ** step)) + 1e-8)
    *rest, bias = weights
    return Model(mean, scale, *rest, float(bias))


def held_out(id_col: str = "doc_id"):
    """True for the fold that no label is learned from: crc32 of the id as text, mod 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on at most ``max_docs`` labelled documents outside the held-out fold, those with the
    smallest id hashes, with all their passages.

    A document's label is the smallest of its label rows; labels other than 0 and 1 and null
    ids are ignored. Returns None where not a single labelled document can be read.
    """
    sample = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out("doc_id"))
              .groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, 1):
                x, doc_of = features([(t.as_py() or "").encode() for t in b.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc_of)), b.column(2).take(pa.array(doc_of)),
                     pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "y", "x"])

    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")     # at most max_docs rows
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
            .mapInArrow(run, "doc_id long, y int, x binary").toPandas())
    if rows.empty:
        return None
    rows = rows.sort_values("doc_id", kind="stable")
    ids, doc_of = np.unique(rows["doc_id"].to_numpy(), return_inverse=True)
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, WIDTH)
    y = rows["y"].to_numpy()[np.searchsorted(doc_of, np.arange(len(ids)))]
    return fit(x, doc_of, y.astype(np.float64))


def scored(model: Model | None, texts: list[str | None]) -> np.ndarray:
    """Scores of whole texts, between 0 and 1; 0.5 without a model."""
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    x, doc_of = features([(t or "").encode() for t in texts])
    return model.score(x, doc_of)


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row. Null and blank texts are scored as a bag of one empty passage."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scored(model, b.column(1).to_pylist()), pa.float64())],
                                                 ["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double"))


def keep_good(docs: DataFrame, model: Model | None, threshold: float = KEEP, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the documents scored below ``threshold``. Map only.
    Without a model nothing is rejected."""
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, at):
                yield b.filter(pa.array(scored(model, b.column(at).to_pylist()) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = KEEP, max_docs: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    s = score_documents(docs, train(docs, labels, max_docs))
    return s.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))
