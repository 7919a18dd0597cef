"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed words and character n-grams, its
class the softmax of a linear output, trained by numpy stochastic gradient descent on a
bounded sample of labelled rows (``sample_rows``, those with the smallest hash of doc_id). The
model is ``buckets`` x ``dim`` floats whatever the corpus; scoring is one Arrow pass in which
each bucket's two-class logit is a single number, so no vectors are gathered per token.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresight.llm import textnum as X

BUCKETS = 1 << 17
DIM = 12
SAMPLE_ROWS = 8_000
NGRAMS = (2, 3, 4)


def features(data: np.ndarray, off: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of documents and their offsets: every word, every pair of neighbouring
    words in their order, whether a word repeats the one before it, and every character n-gram
    (2 to 4 bytes) inside a word. Case is kept."""
    start, end, h, wo = X.words(data, off, lower=False)
    n = len(off) - 1
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    doc = np.repeat(np.arange(n), np.diff(wo))
    parts, docs = [h], [doc]
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    parts.append(X.mix(h[pair] * np.uint64(0x9E3779B97F4A7C15) + h[pair + 1]))
    docs.append(doc[pair])
    same = pair[h[pair + 1] == h[pair]]
    parts.append(np.full(len(same), 0xA5A5A5A5A5, np.uint64))
    docs.append(doc[same])
    a = data[off[0]:off[-1]].astype(np.uint64)
    s0, e0 = start - off[0], end - off[0]
    length = e0 - s0
    for k in NGRAMS:
        if len(a) < k:
            continue
        g = np.full(len(a) - k + 1, k, np.uint64)
        for j in range(k):
            g = g * np.uint64(0x100000001B3) + a[j:len(a) - k + 1 + j]
        many = np.maximum(length - k + 1, 0)
        pos = np.repeat(s0 - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
        parts.append(X.mix(g[pos]))
        docs.append(np.repeat(doc, many))
    ids = np.concatenate(parts)
    d = np.concatenate(docs)
    order = np.argsort(d, kind="stable")
    return (ids[order] % np.uint64(buckets)).astype(np.int64), np.searchsorted(d[order], np.arange(n + 1))


def document_counts(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    ids, _ = features(np.frombuffer(text, np.uint8), np.array([0, len(text)], np.int64), buckets)
    u, c = np.unique(ids, return_counts=True)
    return u, (c / max(1, len(ids))).astype(np.float32)


class Model:
    """Learned vectors ``e`` (buckets, dim), output ``w`` (dim, 2), bias ``b`` (2)."""

    def __init__(self, buckets: int, dim: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.e = ((rng.random((buckets, dim)) - 0.5) / dim).astype(np.float32)
        self.w = np.zeros((dim, 2), np.float32)
        self.b = np.zeros(2, np.float32)

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int | None = None, rate: float = 4.0, seed: int = 6) -> "Model":
        """SGD on the log loss, one document a step, rate falling linearly to zero; 8 epochs,
        more (100 at most) where that is less than 6000 steps."""
        epochs = epochs or min(100, max(8, -(-6000 // max(1, len(rows)))))
        rng = np.random.default_rng(seed)
        steps, t = max(1, epochs * len(rows)), 0
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                u, x = rows[i]
                lr = rate * (1 - t / steps)
                t += 1
                v = x @ self.e[u]
                z = v @ self.w + self.b
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y[i]] -= 1.0
                back = self.w @ p
                self.w -= (lr * 0.25) * np.outer(v, p)
                self.b -= (lr * 0.01) * p
                if len(u):
                    self.e[u] -= (lr * x)[:, None] * back[None, :]
        return self

    def logits(self) -> tuple[np.ndarray, float]:
        """Class-1 log odds that each bucket adds, and the bias."""
        d = self.w[:, 1] - self.w[:, 0]
        return (self.e @ d).astype(np.float64), float(self.b[1] - self.b[0])


def _score(add: np.ndarray, bias: float):
    def run(batches):
        for batch in batches:
            data, off = X.utf8(batch.column(batch.num_columns - 1))
            out = np.empty(batch.num_rows)
            for d, e in X.groups(off, 1 << 17):
                ids, fo = features(data, off[d:e + 1], len(add))
                n = np.diff(fo)
                total = np.concatenate([[0.0], np.cumsum(add[ids])])
                z = bias + (total[fo[1:]] - total[fo[:-1]]) / np.maximum(n, 1)
                out[d:e] = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out)], names=[*batch.schema.names[:-1], "score"])
    return run


def _learn(buckets: int, dim: int):
    def run(batches):
        texts, labels = [], []
        for b in batches:
            texts += [x or "" for x in b.column(0).to_pylist()]
            labels += b.column(1).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
        x = [document_counts(texts[i].encode("utf-8"), buckets) for i in order]
        y = np.array([1 if labels[i] else 0 for i in order], dtype=np.int64)
        model = Model(buckets, dim)
        if len(set(y)) == 2:
            model.train(x, y)
        elif len(y):
            model.b[int(y[0])] += 4.0
        add, bias = model.logits()
        yield pa.RecordBatch.from_arrays([pa.array([add.tobytes()], pa.binary()), pa.array([bias])], names=["add", "bias"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS,
        dim: int = DIM) -> tuple[np.ndarray, float]:
    """Per-bucket logits and bias, learned in one task from the labelled documents outside the
    held-out fold; of more than ``sample_rows`` labels (documented bound) those with the
    smallest hash of doc_id are used. Only their ids are broadcast, so texts are not shuffled.
    Several labels of one doc_id count each, a null doc_id or label not at all."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")) \
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(lab), "doc_id").select("text", "label")
    r = sample.repartition(1).mapInArrow(X.tidy(_learn(buckets, dim)), "add binary, bias double").first()
    if r is None:       # no labelled rows: an even score
        return np.zeros(buckets), 0.0
    return np.frombuffer(bytes(r["add"]), np.float64), float(r["bias"])


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` and ``score`` (probability of label 1).

    A null or empty text, or one of white space, has no features: its score is the sigmoid of
    the bias. Long texts are scored whole. An empty training set gives 0.5 throughout."""
    add, bias = model
    src = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(X.tidy(_score(add, bias)), f"{schema}, score double" if schema else "score double")


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold, else 0) for every row.

    Learns from ``labels.quality`` of rows whose crc32(doc_id as text) mod 4 is not 2; inputs
    of a score are the text alone. A null doc_id is scored with held_out null."""
    model = fit(docs, labels, sample_rows=sample_rows)
    s = score(docs.withColumn("doc_id", F.col("doc_id").cast("long")), model, ["doc_id"])
    return s.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
