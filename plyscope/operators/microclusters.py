"""Clustering features in adaptive cells, and Ward merging of them.

The points lie in blocks. Cells are those of a binary tree that grows from one cell for all points: in every round, one
pass adds up count, linear sums and squared sums of each cell, and the cells with the largest radii are cut at their
mean across their widest axis, until no cell exceeds the radius asked for or the number of cells allowed is reached. So
the number of features is bounded whatever the scale of the data, and dense regions get small cells. Cells of equal
points are never cut.

Ward's hierarchy starts from the features, each standing for its points: in every round all pairs of clusters that are
each other's nearest merge at once. Nothing else could come between such a pair, so the merges and their heights are
those of one merge at a time. Few points, each a feature of its own, give the exact hierarchy of the points.

Points with a NULL or NaN coordinate take no part and get no cell.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plyscope.operators.multistart import _pass, point_blocks

MOST_CELLS = 1000


@dataclass
class Cells:
    """A binary tree of cells: ``axis`` -1 marks the leaves; ``n``, ``sums`` and ``squares`` add up the points of each."""

    axis: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    n: list[float] = field(default_factory=lambda: [0.0])
    sums: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])
    squares: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every point."""
        axis, cut, left = np.asarray(self.axis), np.asarray(self.cut), np.asarray(self.left)
        at = np.zeros(len(x), dtype=np.int64)
        everyone = np.arange(len(x))
        while True:
            a = axis[at]
            if (a < 0).all():
                return at
            at = np.where(a < 0, at, left[at] + (x[everyone, np.maximum(a, 0)] > cut[at]))

    def leaves(self) -> list[int]:
        return [i for i, a in enumerate(self.axis) if a < 0]

    def spread(self, i: int) -> np.ndarray:
        """Variance of each coordinate inside a cell."""
        return np.maximum(self.squares[i] / self.n[i] - (self.sums[i] / self.n[i]) ** 2, 0.0)

    def divide(self, i: int) -> None:
        axis = int(self.spread(i).argmax())
        self.axis[i], self.cut[i], self.left[i] = axis, float(self.sums[i][axis] / self.n[i]), len(self.axis)
        for _ in range(2):
            self.axis.append(-1)
            self.cut.append(0.0)
            self.left.append(-1)
            self.n.append(0.0)
            self.sums.append(np.zeros(0))
            self.squares.append(np.zeros(0))

    def column(self, coords: list[str], values: list[int] | None = None) -> Column:
        """Leaf of a row, or the value given to that leaf; NULL for an unknown coordinate."""
        leaf_value = np.arange(len(self.axis)) if values is None else np.full(len(self.axis), -1)
        if values is not None:
            leaf_value[self.leaves()] = values

        @F.pandas_udf("int")
        def cell(v: pd.Series) -> pd.Series:
            x = np.array([np.asarray(a, dtype=float) for a in v]).reshape(len(v), len(coords))
            unknown = np.isnan(x).any(axis=1)
            found = leaf_value[self.route(np.nan_to_num(x))]
            return pd.Series(found, dtype="Int32").mask(unknown)

        return cell(F.array(*[F.col(c).cast("double") for c in coords]))


def adaptive_cells(points: DataFrame, coords: list[str], most: int = MOST_CELLS, radius: float = 0.0) -> Cells:
    """Cells of at most ``radius``, as far as ``most`` of them allow; the radius is the root mean square distance to the mean."""
    blocks = point_blocks(points, coords)
    cells, d = Cells(), len(coords)
    fresh = [0]
    while fresh:
        place = np.full(len(cells.axis), -1)
        place[fresh] = np.arange(len(fresh))
        shape = (cells.axis, cells.cut, cells.left)

        def moments(x, w, h, place=place, shape=shape, size=len(fresh)):
            at = place[Cells(*shape).route(x)]
            x, at = x[at >= 0], at[at >= 0]
            columns = [np.bincount(at, minlength=size)] + [np.bincount(at, v, size) for j in range(d) for v in (x[:, j], x[:, j] ** 2)]
            return np.stack(columns, axis=1).astype(float)

        found = _pass(blocks, {0: moments})
        if not found:
            return cells
        for i, row in zip(fresh, found[0], strict=True):
            cells.n[i], cells.sums[i], cells.squares[i] = row[0], row[1::2], row[2::2]
        # rounding must not cut cells of equal points
        noise = lambda i: 1e-12 * (cells.squares[i].sum() / max(cells.n[i], 1.0))
        leaves = [i for i in cells.leaves() if cells.n[i] > 0]
        wide = [(cells.spread(i).sum(), i) for i in leaves]
        wide = sorted(((r, i) for r, i in wide if cells.n[i] > 1 and r > max(radius**2, noise(i))), reverse=True)
        fresh = []
        # the widest half of what may be cut, so that a round's means guide the next
        room = most - len(leaves)
        for _, i in wide[: max(1, min(room, (len(wide) + 1) // 2))] if room > 0 else []:
            cells.divide(i)
            fresh += [cells.left[i], cells.left[i] + 1]
    return cells


def features(cells: Cells, spark, coords: list[str]) -> DataFrame:
    """One row for every cell: n, sums, squared sum and the mean."""
    rows = []
    for i in cells.leaves():
        if cells.n[i] > 0:
            sums = [float(v) for v in cells.sums[i]]
            rows.append((i, int(cells.n[i]), *sums, float(cells.squares[i].sum()), *[v / float(cells.n[i]) for v in sums]))
    names = ["cell int", "n long", *[f"sum_{c} double" for c in coords], "sum_squares double", *[f"`{c}` double" for c in coords]]
    return spark.createDataFrame(rows, ", ".join(names))


def ward(means: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (smaller member, smaller member, height) in rising height.

    The height is the root of twice the growth of the sum of squares, the distance for two single points. A cluster is
    called by its smallest first feature.
    """
    means, weights = means.astype(float).copy(), weights.astype(float).copy()
    alive = np.arange(len(means))
    merges = []
    while len(alive) > 1:
        m, w = means[alive], weights[alive]
        squares = np.einsum("ij,ij->i", m, m)
        gaps = np.maximum(squares[:, None] + squares[None] - 2 * m @ m.T, 0.0) * (2 * w[:, None] * w[None] / (w[:, None] + w[None]))
        np.fill_diagonal(gaps, np.inf)
        best = gaps.argmin(axis=1)
        pairs = [(i, int(j)) for i, j in enumerate(best) if i < j and best[j] == i]
        if not pairs:  # rounding broke a tie in a ring
            i, j = sorted(np.unravel_index(gaps.argmin(), gaps.shape))
            pairs = [(int(i), int(j))]
        gone = []
        for i, j in pairs:
            a, b = alive[i], alive[j]
            exact = ((means[a] - means[b]) ** 2).sum() * 2 * weights[a] * weights[b] / (weights[a] + weights[b])
            merges.append((int(a), int(b), float(np.sqrt(exact))))
            means[a] = (means[a] * weights[a] + means[b] * weights[b]) / (weights[a] + weights[b])
            weights[a] += weights[b]
            gone.append(j)
        alive = np.delete(alive, gone)
    return sorted(merges, key=lambda x: x[2])


def cut_tree(count: int, merges: list[tuple[int, int, float]], k: int) -> list[int]:
    """Cluster of every feature after all but the last k - 1 merges; clusters are numbered by their smallest member."""
    parent = list(range(count))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b, _ in merges[: max(0, count - k)]:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    order = {r: n for n, r in enumerate(sorted({root(i) for i in range(count)}))}
    return [order[root(i)] for i in range(count)]
