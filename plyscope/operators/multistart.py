"""k-means from many starts at once: all runs, of any k, share every pass over the points.

The points lie in blocks. A pass measures each point against the centres of all runs that still move and adds up, for
each run and centre, the weight, the weighted sum and the cost; partial sums of a run meet in one small group. A run
stops by itself once its centres rest, so a sweep over k with many restarts costs as many passes as its longest run.

Starts follow k-means||: one point, then some rounds in which every point joins with a chance that grows with its
squared distance, over all runs at once; the candidates, weighted by the points nearest to them, are thinned out to k by
k-means++. Chances come from hashes of (seed, round, coordinates), so a run does not depend on the partitioning or on
the runs beside it. Points with a NULL or NaN coordinate, or without a positive weight, shape no centre.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plyscope.operators.trees import _fractions
from plyscope.schema import SEED
from plyscope.session import cut_lineage

BLOCK_ROWS = 1 << 16
STEPS = 2
MOST_PASSES = 300
#: Centres rest when their squared moves sum to less than this share of the mean variance of the coordinates.
REST = 1e-4


@dataclass
class Run:
    k: int
    seed: int
    centers: np.ndarray
    cost: float = float("inf")
    passes: int = 0
    converged: bool = False


def point_blocks(points: DataFrame, coords: list[str], weight: str | None = None) -> DataFrame:
    """Blocks (rows, x, w, h) of the points that take part."""
    x = F.array(*[F.col(c).cast("double") for c in coords])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c)) & (F.col("w") > 0)
    rows = points.select(x.alias("x"), w.alias("w")).where(whole).select("x", "w", F.xxhash64("x").alias("h"))
    rows = cut_lineage(rows)
    parts = max(1, -(-rows.count() // BLOCK_ROWS))

    def pack(batches):
        for batch in batches:
            x_ = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()
            cells = [pa.array([batch.num_rows], pa.int32()), pa.array([x_], pa.binary())]
            cells += [pa.array([batch.column(i).to_numpy().astype(t).tobytes()], pa.binary()) for i, t in ((1, "<f8"), (2, "<i8"))]
            yield pa.RecordBatch.from_arrays(cells, names=["rows", "x", "w", "h"])

    return cut_lineage(rows.repartition(parts).mapInArrow(pack, "rows int, x binary, w binary, h binary"))


def _pass(blocks: DataFrame, jobs: dict[int, Callable]) -> dict[int, np.ndarray]:
    """For each run its function of a block (x, w, h), which gives an array, summed over all blocks in one pass."""

    def partial(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                x = np.frombuffer(r["x"], "<f8").reshape(r["rows"], -1)
                w, h = np.frombuffer(r["w"], "<f8"), np.frombuffer(r["h"], "<i8").view(np.uint64)
                for run, job in jobs.items():
                    part = job(x, w, h)
                    totals[run] = totals[run] + part if run in totals else part
        for run, total in totals.items():
            cells = [pa.array([run]), pa.array([list(total.shape)], pa.list_(pa.int32())), pa.array([total.astype("<f8").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=["run", "shape", "data"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = shape = None
        for batch in batches:
            for r in batch.to_pylist():
                part = np.frombuffer(r["data"], "<f8")
                total, shape = (part.copy(), r["shape"]) if total is None else (total + part, shape)
        cells = [pa.array([key[0].as_py()]), pa.array([shape], pa.list_(pa.int32())), pa.array([total.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(cells, names=["run", "shape", "data"])

    sums = blocks.mapInArrow(partial, _SUMS)
    if blocks.rdd.getNumPartitions() > 1:
        sums = sums.groupBy("run").applyInArrow(add, _SUMS)
    return {r["run"]: np.frombuffer(r["data"], "<f8").reshape(r["shape"]) for r in sums.collect()}


_SUMS = "run long, shape array<int>, data binary"


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre, the first of equals, and its squared distance."""
    gaps = np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)
    at = gaps.argmin(axis=1)
    return at, gaps[np.arange(len(x)), at]


def _sampled(blocks: DataFrame, chances: dict[int, Callable], salts: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
    """For each run the distinct points whose hash falls below their chance: some k of them, as expected."""

    def pick(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x = np.frombuffer(r["x"], "<f8").reshape(r["rows"], -1)
                w, h = np.frombuffer(r["w"], "<f8"), np.frombuffer(r["h"], "<i8").view(np.uint64)
                for run, chance in chances.items():
                    taken = np.unique(x[_fractions(h, *salts[run]) < chance(x, w)], axis=0)
                    if len(taken):
                        yield pa.RecordBatch.from_arrays([pa.array([run] * len(taken)), pa.array(taken.tolist(), pa.list_(pa.float64()))], names=["run", "x"])

    found: dict[int, list] = {}
    for r in blocks.mapInArrow(pick, "run long, x array<double>").distinct().collect():
        found.setdefault(r["run"], []).append(r["x"])
    return {run: np.array(sorted(v)) for run, v in found.items()}


def _first(blocks: DataFrame, runs: list[Run]) -> dict[int, np.ndarray]:
    """For each run the point whose hash is smallest."""
    salts = {i: (run.seed, run.k) for i, run in enumerate(runs)}

    def pick(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x = np.frombuffer(r["x"], "<f8").reshape(r["rows"], -1)
                for i, salt in salts.items():
                    u = _fractions(np.frombuffer(r["h"], "<i8").view(np.uint64), *salt)
                    at = int(u.argmin())
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([u[at]]), pa.array([x[at].tolist()], pa.list_(pa.float64()))], names=["run", "u", "x"])

    rows = blocks.mapInArrow(pick, "run long, u double, x array<double>").groupBy("run").agg(F.min(F.struct("u", "x")).alias("m")).collect()
    return {r["run"]: np.array([r["m"]["x"]]) for r in rows}


def _plus_plus(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ and some Lloyd steps over few weighted candidates."""
    rng = np.random.default_rng(seed)
    if len(points) <= k:
        return points
    at = [int(rng.choice(len(points), p=weights / weights.sum()))]
    for _ in range(k - 1):
        mass = nearest(points, points[at])[1] * weights
        if mass.sum() <= 0:
            break
        at.append(int(rng.choice(len(points), p=mass / mass.sum())))
    centers = points[at]
    for _ in range(30):
        owner, _ = nearest(points, centers)
        for c in range(len(centers)):
            w = np.where(owner == c, weights, 0.0)
            if w.sum() > 0:
                centers[c] = (points * w[:, None]).sum(axis=0) / w.sum()
    return centers


def _starts(blocks: DataFrame, runs: list[Run]) -> list[np.ndarray]:
    candidates = _first(blocks, runs)
    for step in range(STEPS):
        held = dict(candidates)
        jobs = {i: (lambda x, w, h, c=c: np.array([(nearest(x, c)[1] * w).sum()])) for i, c in held.items()}
        costs = {i: float(v[0]) for i, v in _pass(blocks, jobs).items()}
        open_ = {i: c for i, c in held.items() if costs[i] > 0}
        if not open_:
            break
        chances = {i: (lambda x, w, c=c, f=2.0 * runs[i].k / costs[i]: f * nearest(x, c)[1] * w) for i, c in open_.items()}
        salts = {i: (runs[i].seed, runs[i].k, step + 1) for i in open_}
        for i, more in _sampled(blocks, chances, salts).items():
            candidates[i] = np.unique(np.concatenate([candidates[i], more]), axis=0)
    jobs = {i: (lambda x, w, h, c=c: np.bincount(nearest(x, c)[0], w, len(c))) for i, c in candidates.items()}
    weights = _pass(blocks, jobs)
    return [_plus_plus(candidates[i], weights[i], run.k, run.seed) for i, run in enumerate(runs)]


def multi_start(
    points: DataFrame, coords: list[str], starts: list[tuple[int, int]], weight: str | None = None, most_passes: int = MOST_PASSES
) -> list[Run]:
    """A fitted run for every (k, seed). A run has fewer centres where there are fewer distinct points."""
    blocks = point_blocks(points, coords, weight)
    runs = [Run(k, seed, np.zeros((0, len(coords)))) for k, seed in starts]
    moments = _pass(blocks, {0: lambda x, w, h: np.concatenate([[w.sum()], w @ x, w @ (x * x)])})
    if not moments:
        return runs
    n, d = moments[0][0], len(coords)
    variance = np.maximum(moments[0][d + 1 :] / n - (moments[0][1 : d + 1] / n) ** 2, 0.0)
    rest = REST * float(variance.mean())
    for run, centers in zip(runs, _starts(blocks, runs), strict=True):
        run.centers = centers

    def sums(centers):
        def job(x, w, h):
            at, gap = nearest(x, centers)
            columns = [np.bincount(at, w, len(centers)), np.bincount(at, w * gap, len(centers))]
            columns += [np.bincount(at, w * x[:, j], len(centers)) for j in range(x.shape[1])]
            return np.stack(columns, axis=1)

        return job

    moving = list(range(len(runs)))
    while moving:
        found = _pass(blocks, {i: sums(runs[i].centers) for i in moving})
        still = []
        for i in moving:
            run, total = runs[i], found[i]
            run.cost, run.passes = float(total[:, 1].sum()), run.passes + 1
            if run.converged or run.passes >= most_passes:
                continue
            some = total[:, 0] > 0
            moved = np.where(some[:, None], total[:, 2:] / np.maximum(total[:, :1], 1e-300), run.centers)
            run.converged = float(((moved - run.centers) ** 2).sum()) <= rest
            run.centers = moved  # one more pass gives the cost of the last move
            still.append(i)
        moving = still
    return runs


def best_runs(points: DataFrame, coords: list[str], ks, seed: int = SEED, restarts: int = 10, weight: str | None = None) -> dict[int, Run]:
    """For each k the run of least cost, the first of equals."""
    ks = list(dict.fromkeys(ks))
    runs = multi_start(points, coords, [(k, seed + i) for k in ks for i in range(restarts)], weight)
    return {k: min((r for r in runs if r.k == k), key=lambda r: r.cost) for k in ks}
