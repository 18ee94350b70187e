"""Whitening of vectors by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

Each component c becomes the integer floor(256 c). The covariance V is taken over the distinct integer vectors (the fit
list, n of them with sums S), is centred before it is multiplied, and is never formed: all that is known of it are
products with a few vectors, each a pass over blocks of the fit list that adds up ``Z'(Z u)`` for z = x - S/n.

The subspace starts with seeded random vectors. Every round takes the Ritz pairs of the subspace (Rayleigh-Ritz), locks
the leading ones whose residual, from a fresh product, lies at rounding level, and for the others solves the projected
correction equation ``(I - QQ')(V - theta)(I - QQ') t = -r`` by some steps of MINRES, Q holding the locked vectors and
the pair's own. The solvers of all open pairs go in step, so that one pass serves them all. The solutions widen the
subspace, which is cut back to its best vectors once it is full. It goes on until all pairs are locked; a subspace as
wide as the vectors is exact.

Rows whose vector is NULL or holds a NULL, NaN or infinite component take no part; neither do empty vectors, which have
no component. All others, rows without an id and repeated ones too, get their components. Vectors of different
dimensions are whitened apart, each dimension over its own fit list. Where a direction has no variance (a constant
table, a single vector, fewer vectors than components), ``whitened`` is NULL, and so is ``explained`` where V is zero.
``deviation`` is NULL where it exceeds a long. Extra columns are left out of the result. The integers must stay below
2**53 in size; larger ones raise.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plyscope.llm.common import settled, tasks_for

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 4096
TASK_ROWS = 16 * BLOCK_ROWS
#: Sums of more tasks than this are added up in a round of their own before they reach the driver.
DIRECT = 256
INNER = 14
SUBSPACE = 32
ROUNDS = 60
#: A residual below this share of the largest eigenvalue is at rounding level.
ROUNDING = 2.0**-43
LARGEST = 2.0**53


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x array<long>) of the rows that take part."""
    v = F.col("v")
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(v, lambda c: F.floor(c * SCALE))
    inside = F.forall(v, lambda c: F.abs(c * SCALE) <= LARGEST)
    checked = F.when(inside, whole).otherwise(F.raise_error(F.lit("a component exceeds 2**53 after scaling")))
    return rows.where(v.isNotNull() & finite & (F.size(v) > 0)).select("id", checked.alias("x"))


def fit_blocks(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks (dims, data) of the distinct vectors; data holds 64-bit integers, row by row."""

    def pack(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            lists = batch.column(0)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<i8")
            ends = np.cumsum(lengths)
            for d in np.unique(lengths).tolist():
                held.setdefault(d, []).append(values[(ends[lengths == d] - d)[:, None] + np.arange(d)])
                if sum(map(len, held[d])) >= block_rows:
                    yield block(d, np.concatenate(held.pop(d)))
        for d, parts in held.items():
            yield block(d, np.concatenate(parts))

    def block(d: int, m: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([m.tobytes()], pa.binary())], names=["dims", "data"])

    distinct = settled(vectors.select("x").distinct())
    tasks = tasks_for(distinct.count(), TASK_ROWS)
    return settled(distinct.repartition(tasks).mapInArrow(pack, "dims int, data binary"))


def summed(blocks: DataFrame, function) -> np.ndarray:
    """``function(int64 matrix)`` added up over all blocks: one array a task, more than a few of them by way of a
    second round of tasks, so that at most max(DIRECT, the root of their number) reach the driver."""

    def partial(batches):
        total = None
        for batch in batches:
            for d, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = function(np.frombuffer(data, "<i8").reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield _row(total)

    sums = blocks.mapInArrow(partial, _SUMS)
    tasks = blocks.rdd.getNumPartitions()
    if tasks > DIRECT:
        sums = sums.repartition(int(tasks**0.5)).mapInArrow(_added, _SUMS)
    parts = [np.frombuffer(r["data"], r["kind"]).reshape(r["shape"]) for r in sums.collect()]
    return sum(parts[1:], parts[0])


_SUMS = "kind string, shape array<int>, data binary"


def _row(total: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([total.dtype.str]), pa.array([list(total.shape)], pa.list_(pa.int32())), pa.array([total.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(cells, names=["kind", "shape", "data"])


def _added(batches):
    total = None
    for batch in batches:
        for r in batch.to_pylist():
            part = np.frombuffer(r["data"], r["kind"]).reshape(r["shape"])
            total = part if total is None else total + part
    if total is not None:
        yield _row(total)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Exact n*x - S: 64-bit integers, or Python's where those would not do."""
    room = 2**62
    if n * int(np.abs(x).max(initial=0)) < room and max(map(abs, sums), default=0) < room:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squares(deviation: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None beyond a long."""
    if deviation.dtype != object and len(deviation):
        if int(np.abs(deviation).max()) ** 2 * deviation.shape[1] < 2**63:
            return (deviation * deviation).sum(axis=1).tolist()
    totals = [sum(int(c) ** 2 for c in row) for row in deviation]
    return [t if t < 2**63 else None for t in totals]


def minres(b: np.ndarray, steps: int, target: float):
    """MINRES for a symmetric operator, as a generator: it yields a vector, is sent its product and returns the solution.

    It stops after ``steps`` products or once the residual is ``target`` times that of zero.
    """
    beta = first = float(np.linalg.norm(b))
    x = np.zeros_like(b)
    if not first:
        return x
    v, v_old = b / beta, np.zeros_like(b)
    w, w_old = np.zeros_like(b), np.zeros_like(b)
    c, c_old, s, s_old, eta, beta_v = 1.0, 1.0, 0.0, 0.0, beta, 0.0
    for _ in range(steps):
        p = yield v
        alpha = float(v @ p)
        p = p - alpha * v - beta_v * v_old
        beta = float(np.linalg.norm(p))
        # the two latest rotations on the new column of the tridiagonal matrix
        delta = c * alpha - c_old * s * beta_v
        upper = s * alpha + c_old * c * beta_v
        top = s_old * beta_v
        length = float(np.hypot(delta, beta))
        if not length:
            return x
        c_old, s_old, c, s = c, s, delta / length, beta / length
        w_new = (v - top * w_old - upper * w) / length
        x = x + c * eta * w_new
        eta = -s * eta
        if not beta or abs(eta) <= target * first:
            return x
        v_old, v, beta_v = v, p / beta, beta
        w_old, w = w, w_new
    return x


@dataclass
class Whitening:
    """Fit list figures of one dimension, and the leading eigenpairs: values, and vectors as columns."""

    dims: int
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None
    passes: int

    def scales(self) -> np.ndarray:
        """Roots of the eigenvalues, NaN where there is no variance."""
        some = self.values > ROUNDING * max(self.trace, 0.0)
        return np.sqrt(np.where(some, self.values, np.nan))

    def project(self, x: np.ndarray) -> np.ndarray:
        z = deviations(x, self.n, self.sums).astype(np.float64) / self.n
        return z @ self.vectors / self.scales()


def jacobi_davidson(multiply, dims: int, wanted: int, seed: int = 42, inner: int = INNER, subspace: int = SUBSPACE):
    """Largest eigenvalues (falling) and their unit vectors of the symmetric operator ``multiply`` (matrix -> product)."""
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dims)
    q = np.linalg.qr(rng.standard_normal((dims, min(dims, wanted + 4))))[0]
    aq = multiply(q)
    for _ in range(ROUNDS):
        h = q.T @ aq
        values, y = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, y = values[order], y[:, order]
        if q.shape[1] > subspace:  # back to the best vectors
            y = y[:, : wanted + 4]
            q, aq, values = q @ y, aq @ y, values[: wanted + 4]
            y = np.eye(len(values))
        u, theta = q @ y[:, :wanted], values[:wanted]
        u, triangle = np.linalg.qr(u)
        u *= np.sign(np.diag(triangle))
        product = multiply(u)
        theta = np.einsum("ij,ij->j", u, product)
        residuals = product - u * theta
        lengths = np.linalg.norm(residuals, axis=0)
        level = ROUNDING * max(float(np.abs(values).max(initial=0.0)), np.finfo(float).tiny)
        if q.shape[1] == dims or (lengths <= level).all():
            return theta, u
        locked = 0
        while lengths[locked] <= level:
            locked += 1
        solvers = []
        for j in range(locked, wanted):
            if lengths[j] <= level:
                continue  # settled, but not yet all before it
            kept = u[:, [*range(locked), j]]
            r = residuals[:, j] - kept @ (kept.T @ residuals[:, j])
            solver = minres(-r, inner, 1e-4)
            solvers.append([solver, next(solver, None), kept, theta[j], None])
        while any(s[4] is None for s in solvers):
            going = [s for s in solvers if s[4] is None]
            outside = [s[1] - s[2] @ (s[2].T @ s[1]) for s in going]
            done = multiply(np.column_stack(outside))
            for s, v, p in zip(going, outside, done.T, strict=True):
                p = p - s[3] * v
                try:
                    s[1] = s[0].send(p - s[2] @ (s[2].T @ p))
                except StopIteration as stop:
                    s[4] = stop.value
        added = []
        for s in solvers:
            t = s[4]
            for _ in range(2):
                for basis in (q, *([np.column_stack(added)] if added else [])):
                    t = t - basis @ (basis.T @ t)
                length = np.linalg.norm(t)
                t = t / length if length else t
            if length and q.shape[1] + len(added) < dims:
                added.append(t)
        if not added:
            added = [_outside(q, rng)]
        new = np.column_stack(added)
        q, aq = np.column_stack([q, new]), np.column_stack([aq, multiply(new)])
    raise ArithmeticError(f"no convergence after {ROUNDS} rounds: residuals {lengths.tolist()}")


def _outside(q: np.ndarray, rng) -> np.ndarray:
    t = rng.standard_normal(len(q))
    for _ in range(2):
        t = t - q @ (q.T @ t)
        t /= np.linalg.norm(t)
    return t


def fit(blocks: DataFrame, dims: int, wanted: int = COMPONENTS, **options) -> Whitening:
    """Figures and eigenpairs of the blocks of one dimension."""
    mine = blocks.where(F.col("dims") == dims)
    limbs = summed(mine, lambda x: np.array([[len(x)] * dims, (x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0)], dtype=object).astype("<i8"))
    n, sums = int(limbs[0, 0]), [int(a) * 2**26 + int(b) for a, b in limbs[1:].T]
    passes = 0

    def centred(x):
        return deviations(x, n, sums).astype(np.float64) / n

    def multiply(u: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x):
            z = centred(x)
            return z.T @ (z @ u)

        return summed(mine, product) / n

    trace = float(summed(mine, lambda x: np.array([(centred(x) ** 2).sum()]))[0]) / n
    values, vectors = jacobi_davidson(multiply, dims, wanted, **options)
    order = np.argsort(-values, kind="stable")
    made = Whitening(dims, n, sums, trace, values[order], vectors[:, order], None, passes)
    known = np.flatnonzero(~np.isnan(made.scales()))
    if len(known):
        mean = summed(mine, lambda x: made.project(x)[:, known].sum(axis=0)) / n

        def product(x):
            w = made.project(x)[:, known] - mean
            return w.T @ w

        made.identity_error = float(np.abs(summed(mine, product) / n - np.eye(len(known))).max())
    return made


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(df: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component, with the figures of the fit."""
    vectors = integer_vectors(df, key, vector)
    blocks = fit_blocks(vectors)
    # one row for each dimension that occurs: a table has one, as a rule
    fits = {r[0]: fit(blocks, r[0], wanted) for r in blocks.select("dims").distinct().orderBy("dims").collect()}

    def project(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            for d in np.unique(lengths).tolist():
                at, made = np.flatnonzero(lengths == d), fits[d]
                x = values[(ends[at] - d)[:, None] + np.arange(d)].astype(np.int64)
                k = len(made.values)
                w = made.project(x).ravel()
                explained = made.values / made.trace if made.trace > 0 else np.full(k, np.nan)
                explained = np.tile(np.maximum(explained, 0.0), len(at))
                error = np.full(len(w), np.nan if made.identity_error is None else made.identity_error)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(at, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(w), made.n)),
                        pa.array([v for v in squares(deviations(x, made.n, made.sums)) for _ in range(k)], pa.int64()),
                        *[pa.array(c, mask=np.isnan(c)) for c in (w, explained, error)],
                    ],
                    names=[part.split()[0] for part in WHITENED.split(", ")],
                )

    return vectors.select(F.col("id").cast("long").alias("id"), "x").mapInArrow(project, WHITENED)
