"""Exact top-k search by block-at-a-time pruning.

Vector components become integer weights of terms (dimensions). Candidates are cut in document-range
blocks in task order, each with its forward index (the block's rows) and, for each term, its greatest
and least weight. A query's bound for a block is the sum over terms of the larger product, so no score in
the block is above it. Blocks are taken in order of falling bound, and a query stops when the next bound
is below its k-th score so far; equal bounds are still scored, as ties go to the smaller id.

Queries go out in groups of about ``group`` rows (a hash of the id decides), one group after another: a group is
broadcast, meets all candidates, its results are written and the broadcast is destroyed, so driver and executors
hold one group at a time however many queries there are. Tasks return at most k rows a query, merged by query.

Defined results: vectors that are null, or hold null or non-finite components, take no part; vectors of
different lengths meet on their common dimensions; a query's own id is not its candidate; repeated ids are
candidates of their own, and rows that share a query's id share one answer of k rows; ties go to the smaller
vec_id; a null vec_id neither asks nor is found; texts play no part; empty tables give an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.common import materialize, ship


def quantize(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and floor(scale * component) of the vectors that take part."""
    x = F.col("embedding")
    good = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as one int64 matrix, padded with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    counts = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(counts.max()) if len(counts) else 0), np.int64)
    out[np.arange(out.shape[1]) < counts[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exact: in doubles where no partial sum can pass 2**53."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * width < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class _Best:
    """The k best (score, id) of every query so far, ties to smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.held = np.zeros((n, k), bool)

    def floor(self) -> np.ndarray:
        return np.where(self.held[:, -1], self.score[:, -1], np.iinfo(np.int64).min)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        score = np.concatenate((self.score[rows], scores), axis=1)
        who = np.concatenate((self.id[rows], np.broadcast_to(ids, scores.shape)), axis=1)
        held = np.concatenate((self.held[rows], valid), axis=1)
        order = np.lexsort((who, -score, ~held), axis=1)[:, : self.k]
        at = np.arange(len(rows))[:, None]
        self.score[rows], self.id[rows], self.held[rows] = score[at, order], who[at, order], held[at, order]


def _search(queries: np.ndarray, query_ids: np.ndarray, best: _Best, ids: np.ndarray, rows: np.ndarray, block: int, at_once: int = 4096) -> int:
    """Scores blocks of ``rows`` in order of falling bound for every query until bounds are below its k-th score.

    Returns how many (query, block) pairs were scored.
    """
    starts = list(range(0, len(rows), block))
    tops = np.stack([rows[s : s + block].max(axis=0) for s in starts])
    lows = np.stack([rows[s : s + block].min(axis=0) for s in starts])
    width = min(queries.shape[1], rows.shape[1])
    bound = _product(np.maximum(queries[:, :width], 0), tops[:, :width]) + _product(np.minimum(queries[:, :width], 0), lows[:, :width])
    order = np.argsort(-bound, axis=1, kind="stable")
    alive, done = np.arange(len(queries)), 0
    for step in range(len(starts)):
        alive = alive[bound[alive, order[alive, step]] >= best.floor()[alive]]
        if not len(alive):
            break
        chosen = order[alive, step]
        done += len(alive)
        for b, who in ((b, asked[i : i + at_once]) for b in np.unique(chosen) for asked in [alive[chosen == b]] for i in range(0, len(asked), at_once)):
            part = slice(starts[b], starts[b] + block)
            scores = _product(queries[who], rows[part])
            own = ids[part][None, :] != query_ids[who][:, None]
            keep = min(best.k + 1, scores.shape[1])
            if scores.shape[1] > 4 * keep:  # only scores that can enter; all ties at the cut stay
                cut = np.partition(np.where(own, scores, np.iinfo(np.int64).min), -keep, axis=1)[:, -keep]
                useful = (scores >= np.maximum(cut, best.floor()[who])[:, None]).any(axis=0)
                best.add(who, scores[:, useful], ids[part][useful], own[:, useful])
            else:
                best.add(who, scores, ids[part], own)
    return done


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, block: int = 512, group: int = 32_768) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products."""
    spark = vectors.sparkSession
    ship(spark)
    kept = materialize(quantize(vectors, scale), "terms")
    asked = kept.where(is_query)
    groups = max(1, -(-asked.count() // group))
    out: DataFrame | None = None
    for g in range(groups):
        some = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).toArrow()  # about `group` rows
        sent = spark.sparkContext.broadcast((some.column("vec_id").to_numpy(), _matrix(some.column("terms"))))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            query_ids, queries = sent.value
            best = _Best(len(queries), k)
            for batch in batches:
                if batch.num_rows and len(queries):
                    ids = batch.column(0).to_numpy(zero_copy_only=False)
                    order = np.argsort(ids, kind="stable")  # blocks are ranges of documents
                    _search(queries, query_ids, best, ids[order], _matrix(batch.column(1))[order], block)
            q, at = np.nonzero(best.held)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(best.id[q, at]), pa.array(best.score[q, at])], names=["query_id", "vec_id", "score"])

        found = kept.where("vec_id is not null").select("vec_id", "terms").mapInArrow(search, "query_id long, vec_id long, score long")
        found = materialize(found, "found")
        sent.destroy()
        out = found if out is None else out.unionByName(found)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return out.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
