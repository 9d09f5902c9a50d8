"""Quality classifier: similarity-weighted votes of nearest neighbours in a latent-semantic space.

A text's terms are hashed words and, more heavily, the look of its words: case, first and last byte kinds,
length, words that come twice running, pairs of neighbouring looks, and the share of distinct words. Counts
become log tf-idf; a truncated singular value decomposition of the labelled texts gives the latent axes.
The labelled vectors (at most ``rows``, those of least hash of doc_id and label) are broadcast, each document's
cosine with all of them is computed exactly in blocks, and its ``neighbours`` nearest vote for their labels
by similarity.

Labels are learnt only from rows whose crc32(doc_id as text) mod 5 is not 0; nothing but text enters a score.

Defined results: null and empty texts, and texts without any positive similarity, have the share of label 1
among the labelled texts as score; without labels every score is 1; a null doc_id is never learnt from and
counts as held out; repeated rows get equal results; different labels of a document count as several texts, equal ones
once, and of several texts of one doc_id that with the least hash is learnt from; neighbours at equal similarity (ties)
are taken in any fixed order; very long texts are counted whole; an empty table gives an empty result; other columns are
kept by ``classify``, whatever their names, and ignored by ``score_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import mix64, ship, with_arrow_columns
from docloom.llm.langid import held_out
from docloom.llm.words import Spans, buffers

WORDS, LOOKS = 2048, 1024
DIMS = WORDS + 2 * LOOKS
LOOK_WEIGHT = 2.0

#: Kinds of bytes: lower, upper, digit, beyond ASCII, and each other byte a kind of its own.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A], _KIND[0x80:] = 1, 2, 3, 4
_UPPER = np.zeros(256, np.int32)
_UPPER[0x41:0x5B] = 1
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = 1


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    return (mix64(x.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of DIMS term counts for each text."""
    rows = len(offsets) - 1
    spans = Spans(data, offsets)
    out = np.zeros(rows * DIMS, np.float32)
    if not len(spans.starts):
        return out.reshape(rows, DIMS)
    h = spans.hashes()
    owner = np.repeat(np.arange(rows), np.diff(spans.first)) * DIMS
    start, end = spans.starts, spans.ends
    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    letter = np.concatenate(([0], np.cumsum(_LETTER[data])))
    ups, letters = upper[end] - upper[start], letter[end] - letter[start]
    case = np.where(letters == 0, 0, np.where(ups == letters, np.where(letters > 1, 3, 2), np.where(ups > 0, 2, 1)))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    look = _KIND[data[start]].astype(np.uint64)
    look = look * np.uint64(256) + _KIND[data[end - 1]]
    look = look * np.uint64(256) + _KIND[data[np.maximum(end - 2, start)]]
    look = look * np.uint64(4) + case.astype(np.uint64)
    look = look * np.uint64(2) + same
    pair = np.zeros_like(look)
    pair[1:] = np.where(owner[1:] == owner[:-1], look[:-1] * np.uint64(0x9E3779B97F4A7C15) + look[1:], 0)
    sized = look * np.uint64(16) + np.minimum(end - start, 12).astype(np.uint64)
    at = np.concatenate((owner + _bucket(h, WORDS), owner + WORDS + _bucket(look, LOOKS // 2), owner + WORDS + LOOKS // 2 + _bucket(sized, LOOKS // 2), owner + WORDS + LOOKS + _bucket(pair, LOOKS)))
    return np.bincount(at, minlength=rows * DIMS).astype(np.float32).reshape(rows, DIMS)


def _chunks(column: pa.Array, texts: int = 256) -> Iterator[np.ndarray]:
    """Counts of a column's texts, for at most ``texts`` texts at once."""
    for _, data, offsets in buffers(column, 1 << 20):
        for at in range(0, len(offsets) - 1, texts):
            some = offsets[at : at + texts + 1]
            yield counts(data[some[0] : some[-1]], some - some[0])


@dataclass
class Model:
    """Term weights, latent axes, labelled unit vectors with their labels, and the share of label 1."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int

    def place(self, c: np.ndarray) -> np.ndarray:
        """Unit vectors of texts in the latent space; texts without terms are zero."""
        x = np.log1p(c) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        z = x @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, c: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(c), self.prior)
        near = self.place(c) @ self.vectors.T  # every labelled vector, exactly
        k = min(self.neighbours, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.broadcast_to(np.arange(k), near.shape)
        weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        found = (weight * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.clip(np.where(total > 1e-6, found, self.prior), 0.0, 1.0)


def fit(c: np.ndarray, labels: np.ndarray, rank: int, neighbours: int) -> Model:
    """Term weights and latent axes of labelled texts, by a randomised decomposition."""
    n = len(labels)
    if not n:
        return Model(np.ones(DIMS, np.float32), np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 1.0, neighbours)
    idf = (np.log((n + 1) / ((c > 0).sum(axis=0) + 1)) + 0.1).astype(np.float32)
    idf[WORDS:] *= LOOK_WEIGHT
    x = np.log1p(c) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    q = np.random.default_rng(11).standard_normal((DIMS, min(rank + 16, DIMS)), dtype=np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    axes = (q @ vt.T[:, :rank]).astype(np.float32)
    model = Model(idf, axes, np.zeros((0, 1), np.float32), labels, float(labels.mean()), neighbours)
    model.vectors = model.place(c)
    return model


def learn(docs: DataFrame, labels: DataFrame, rows: int = 4000, rank: int = 64, neighbours: int = 15) -> Model:
    """Fits on at most ``rows`` labelled texts of documents that are not held out: those with the least hashes."""
    spark = docs.sparkSession
    ship(spark)
    open_ = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_quality"))
    chosen = open_.distinct().orderBy(F.xxhash64("_id", "_quality"), "_id", "_quality").limit(rows)
    texts = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"]).select("_id", "_quality", "text")  # `rows` rows at most
    # one text for each label, so that what is collected is bounded by `rows` whatever repeats
    texts = texts.groupBy("_id", "_quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, value = [], []
            for c in _chunks(batch.column(2)):
                for row in c:
                    on = np.flatnonzero(row)
                    at.append(on.astype(np.int32))
                    value.append(row[on])
            kinds = pa.list_(pa.int32()), pa.list_(pa.float32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, kinds[0]), pa.array(value, kinds[1])], names=["id", "quality", "at", "value"])

    found = texts.mapInArrow(count, "id long, quality int, at array<int>, value array<float>").toArrow()
    order = np.lexsort((found.column("quality").to_numpy(), found.column("id").to_numpy()))
    c = np.zeros((len(order), DIMS), np.float32)
    at, value = found.column("at"), found.column("value")
    for r, i in enumerate(order.tolist()):
        c[r, at[i].values.to_numpy()] = value[i].values.to_numpy()
    y = (found.column("quality").to_numpy()[order] == 1).astype(np.float64)
    return fit(c, y, rank, neighbours)


def classify(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` with the score under ``name`` (one that ``docs`` does not have: see free_name)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x rank and rows x rank floats at most

    def make():
        model = sent.value

        def compute(column: pa.Array) -> list[pa.Array]:
            scores = [model.score(c) for c in _chunks(column)]
            return [pa.array(np.concatenate(scores) if scores else [], pa.float64())]

        return compute

    return with_arrow_columns(docs, "text", make, [(name, "double")])


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents."""
    model = learn(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    out = classify(rows, model).withColumnRenamed("quality_score", "score")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
