"""Approximate nearest neighbours by cross-polytope hashing, for the largest inner product.

Every vector becomes a unit vector (one more component makes up for a smaller length, so that the angle to a query
orders vectors as the inner product does). Three rounds of random signs and a fast Hadamard transform stand for a
random rotation, one for each table; the nearest signed axis is the bucket. A query looks into the buckets of its
nearest ``probes`` signed axes in each of ``tables`` tables, and everything found there is ranked by the exact inner
product of the original vectors, ties to the smaller id.

Points and queries of a bucket meet in one sorted run of a partition: points first, then the queries one batch
after the other. A crowded bucket is split into shares of about ``share_rows`` points by id, and its queries go to
each of them. A query whose buckets hold fewer than k vectors is answered by the exact search.

Vectors that are NULL or zero or have NULL or non-finite components take no part, neither do rows without an id. A
vector is not its own neighbour, nor one of another row with the same id. Only vectors of one dimension meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plyscope.llm.common import stored
from plyscope.llm.topk import best_of, exact_top_k
from plyscope.llm.vectors import is_query, whole_vectors

TABLES = 12
PROBES = 10
SHARE_ROWS = 4096
#: Queries whose best a task keeps together before it hands them on.
HELD_QUERIES = 20_000
#: Matrix products may differ from the exact sums by less than this times the lengths.
SLACK = 1e-12
ROUNDS = 3
SEED = 17
HASHED = "dims int, tab int, bucket int, id long, v array<double>"
FOUND = "query_id long, vec_id long, score double"


def hadamard(m: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, h = m.shape[1], 1
    while h < n:
        pairs = m.reshape(len(m), -1, 2, h)
        m = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(m), n)
        h *= 2
    return m / np.sqrt(n)


def signed_axes(m: np.ndarray, number: int) -> np.ndarray:
    """Inner products with the 2n signed axes after the rotation of a table (rows are unit vectors)."""
    rng = np.random.default_rng([SEED, number, m.shape[1]])
    for _ in range(ROUNDS):
        m = hadamard(m * rng.choice([-1.0, 1.0], m.shape[1]))
    return np.concatenate([m, -m], axis=1)


def unit(m: np.ndarray, longest: float | None, extra: bool) -> np.ndarray:
    """Unit rows, padded to a power of two; points (with ``longest``) get the missing length as a component."""
    n, d = m.shape
    width = 1 << max(0, d + extra - 1).bit_length()
    out = np.zeros((n, width))
    if longest is None:
        out[:, :d] = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    else:
        out[:, :d] = m / longest
        if extra:
            out[:, d] = np.sqrt(np.maximum(0.0, 1.0 - (out * out).sum(axis=1)))
    return out


def _hashed(rows: DataFrame, tables: int, nearest: int, longest: float | None, extra: bool, schema: str, with_vector: bool) -> DataFrame:
    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                lists = b.column(1)
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
                values = lists.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(lengths)
                for d in np.unique(lengths):
                    chosen = np.flatnonzero(lengths == d)
                    m = unit(values[(ends[chosen] - d)[:, None] + np.arange(d)], longest, extra)
                    keep = min(nearest, 2 * m.shape[1])
                    take = pa.array(np.repeat(chosen, keep))
                    for t in range(tables):
                        axes = signed_axes(m, t)
                        best = np.argpartition(-axes, keep - 1, axis=1)[:, :keep].astype(np.int32) if keep > 1 else axes.argmax(axis=1).astype(np.int32)
                        n = len(chosen) * keep
                        columns = [pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, t, np.int32)), pa.array(best.reshape(-1))]
                        if with_vector:
                            columns += [b.column(0).take(take), lists.take(take)]
                        yield pa.RecordBatch.from_arrays(columns, names=["dims", "tab", "bucket", "id", "v"][: len(columns)])

    return rows.select("id", "v").mapInArrow(assign, schema)


def nearest(
    df: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding", tables: int = TABLES, probes: int = PROBES, share_rows: int = SHARE_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the rows whose id is divisible by ``every``."""
    rows = whole_vectors(df, key, vector).where(F.exists("v", lambda x: x != 0))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    ends = rows.agg(F.max(norm).alias("most"), F.min(norm).alias("least")).first()
    longest = ends["most"] or 1.0
    extra = bool(ends["most"]) and ends["least"] < longest * (1.0 - 1e-6)
    queries = rows.where(is_query(F.col("id"), every))

    # at most tables x signed axes rows for each dimension
    sizes = _hashed(rows, tables, 1, longest, extra, "dims int, tab int, bucket int", False).groupBy("dims", "tab", "bucket").count()
    shares = F.ceil(F.col("count") / share_rows).cast("int").alias("shares")
    sizes = stored(sizes.select("dims", "tab", "bucket", shares), "bucket-sizes")
    keys = ["dims", "tab", "bucket"]
    points = _hashed(rows, tables, 1, longest, extra, HASHED, True).join(F.broadcast(sizes), keys)
    points = points.select(*keys, F.pmod(F.xxhash64("id"), "shares").cast("int").alias("share"), F.lit(0).alias("asks"), "id", "v")
    asking = _hashed(queries, tables, probes, None, extra, HASHED, True).join(F.broadcast(sizes), keys)
    asking = asking.select(*keys, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(1).alias("asks"), "id", "v")
    order = [*keys, "share"]
    runs = points.unionByName(asking).repartition(*order).sortWithinPartitions(*order, "asks", "id")

    def rank(batches):
        now, ids, held = None, [], []
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def results():
            if best:
                counts = [len(i) for i, _ in best.values()]
                columns = [np.repeat(list(best), counts), np.concatenate([i for i, _ in best.values()]), np.concatenate([s for _, s in best.values()])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])
            best.clear()

        for batch in batches:
            place = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)], axis=1)
            cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                here, d = tuple(place[a, :4].tolist()), int(place[a, 0])
                own = batch.column(5).slice(a, b - a).to_numpy(zero_copy_only=False)
                m = batch.column(6).slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                if here != now:
                    now, ids, held = here, [], []
                if not place[a, 4]:
                    ids.append(own)
                    held.append(m)
                    continue
                if not ids:
                    continue
                ids, held = [np.concatenate(ids)], [np.concatenate(held)]
                length = np.sqrt((held[0] * held[0]).sum(axis=1)).max()
                for at in range(0, len(own), 256):
                    scores = m[at : at + 256] @ held[0].T
                    scores[own[at : at + 256, None] == ids[0][None, :]] = -np.inf
                    for j, s in enumerate(scores, start=at):
                        least = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
                        keep = np.flatnonzero((s >= least - SLACK * length * np.abs(m[j]).sum()) & (s > -np.inf))
                        i, exact = ids[0][keep], (held[0][keep] * m[j]).sum(axis=1)
                        if (old := best.get(int(own[j]))) is not None:
                            i, exact = np.concatenate([old[0], i]), np.concatenate([old[1], exact])
                        order = np.lexsort((i, -exact))
                        i, exact = i[order], exact[order]
                        first = np.sort(np.unique(i, return_index=True)[1])[:k]
                        best[int(own[j])] = (i[first], exact[first])
                    if len(best) >= HELD_QUERIES:
                        yield from results()
        yield from results()

    found = runs.mapInArrow(rank, FOUND).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = stored(best_of(found, k), "nearest")
    full = best.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    rest = queries.join(full, "id", "left_anti")
    if rest.isEmpty():
        return best
    exact = exact_top_k(rest, rows, k)
    return best.join(full.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(exact)
