"""Exact top-k search by columnar branch-and-bound.

Vectors lie in blocks in vertical layout (all first components, then all second ones, ...). Query blocks meet every
block of vectors. Within such a pair the scores are accumulated some dimensions at a time; after each step a
candidate can still gain at most the product of the two remaining lengths (Cauchy-Schwarz), and candidates whose
bound lies below the k-th best score so far are dropped by compacting the columns. What is left at the end is
ranked exactly, ties going to the smaller id.

The set of queries is stated by the caller. It is cut into blocks that are copied once for each share of the
vectors, so that a task holds one block of queries and one of vectors at a time, whatever the sizes of both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plyscope.llm.common import tasks_for
from plyscope.llm.vectors import blocks, unpack

BLOCK_ROWS = 4096
QUERY_ROWS = 512
DIMS_AT_ONCE = 16
FOUND = "query_id long, vec_id long, score double"


def _rest(m: np.ndarray, step: int) -> np.ndarray:
    """Length of what is left of every column behind each step of dimensions (step, column)."""
    squares = m * m
    sums = [squares[at:].sum(axis=0) for at in range(step, len(m), step)]
    return np.sqrt(np.array(sums)) if sums else np.zeros((0, m.shape[1]))


def _kth(scores: np.ndarray, k: int) -> float:
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def search_block(q_ids, q, p_ids, p, k: int, step: int = DIMS_AT_ONCE):
    """The k best columns of ``p`` for every column of ``q``: positions in q, in p, scores."""
    dims = len(q)
    rest_q, rest_p = _rest(q, step), _rest(p, step)
    slack = 1e-9 * (1.0 + np.sqrt((q * q).sum(axis=0)) * np.sqrt((p * p).sum(axis=0)).max(initial=0.0))
    first = q[:step].T @ p[:step] if dims else np.zeros((q.shape[1], p.shape[1]))
    # complete scores of a few columns give the first threshold
    probe = min(p.shape[1], 8 * k)
    known = q.T @ p[:, :probe]
    out = []
    for j in range(q.shape[1]):
        own = p_ids[:probe] == q_ids[j]
        best = _kth(known[j][~own], k)
        at, part = np.flatnonzero(p_ids != q_ids[j]), first[j]
        part = part[at]
        for s, begin in enumerate(range(step, dims, step)):
            room = rest_q[s, j] * rest_p[s, at]
            best = max(best, _kth(part - room, k))
            keep = part + room >= best - slack[j]
            at, part = at[keep], part[keep]
            part = part + q[begin : begin + step, j] @ p[begin : begin + step, at]
        if len(at) > k:
            cut = _kth(part, k)
            keep = part >= cut
            at, part = at[keep], part[keep]
        order = np.lexsort((p_ids[at], -part))[:k]
        out.append((np.full(len(order), j), at[order], part[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def exact_top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, shares: int | None = None
) -> DataFrame:
    """query_id, rank, vec_id, score of the k vectors with the largest inner product.

    Both tables have (id, v array<double>) with finite components. A vector is no candidate of a query with the
    same id, nor of one with another dimension. Fewer than k candidates give fewer rows. Integer components give
    exact scores as long as they stay below 2**53.
    """
    shares = shares or tasks_for(vectors.count(), 4 * block_rows)
    asked = blocks(queries, query_rows).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    held = blocks(vectors.repartition(shares), block_rows).withColumn("share", F.spark_partition_id() % shares)
    pairs = asked.select("share", F.struct("dims", "rows", "ids", "data").alias("q")).join(
        held.select("share", F.struct("dims", "rows", "ids", "data").alias("p")), "share"
    )

    def find(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                q, p = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                if q["dims"] != p["dims"]:
                    continue
                q_ids, qm = unpack(**q)
                p_ids, pm = unpack(**p)
                i, j, score = search_block(q_ids, qm, p_ids, pm, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(p_ids[j]), pa.array(score)], names=["query_id", "vec_id", "score"])

    return best_of(pairs.select("q", "p").mapInArrow(find, FOUND), k)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query, ranked from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
