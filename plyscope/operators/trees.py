"""Trees on binned features, grown level by level from histograms: bagged forests and softmax boosting.

The rows are packed into blocks of binned features once. A level of all growing trees (of a forest, or of all classes of
a boosting round) is one aggregation: tasks route their rows through the trees as far as they have grown and add up, for
every open node, candidate feature and bin, the sums G of the targets, H of their weights and the row count; the parts of
a group of nodes are summed where their best splits are chosen, so only splits reach the driver. A node with no more rows
than a block has gets them sent to one task, which grows all that is below it. A table of at most one block skips the
rounds between: its trees grow inside a task by the same steps. So do the trees of a forest over up to ``TABLE_BLOCKS``
blocks, each in one task that reads them all.

A split maximises ``sum(G^2) / (H + penalty)`` of its two sides. With class counts for G and row weights for H that is the
Gini impurity; with gradients and Hessians it is the gain of second-order boosting. All random choices come from hashes
of (seed, tree, node) or (seed, tree, row), so a tree does not depend on the partitioning, and neither on how many trees
follow it nor, but for its end, on the depth allowed: the first trees of a forest are the forest of as many trees, a tree
cut at a depth is the tree grown to it, and the first rounds of boosting are the shorter boosting. Grids make use of it.

NULL and NaN features go to the right of every split. Rows with a NULL label are left out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from plyscope.schema import SEED
from plyscope.session import cut_lineage, drop_shuffles, scratch_path

BINS = 32
BLOCK_ROWS = 1 << 16
#: Cells of histograms that a task holds at once.
CELLS = 1 << 23
#: Rows of nodes that are counted at once, and rows a node from which it has histograms.
COUNTED_ROWS = 1 << 14
DENSE_ROWS = 64
#: Rounds of boosting after which the margins are written anew.
KEEP_MARGINS = 4
#: Rows whose votes meet in one group.
VOTE_ROWS = 4096
#: Blocks up to which a task that grows whole trees reads the whole table, and trees whose rows are sent at a time beyond that.
TABLE_BLOCKS = 16
SENT_TREES = 16
#: Trees whose votes are summed up where they grow, over several blocks.
VOTE_TREES = 20
BLOCK = "rows int, x binary, y binary, w binary, h binary, margins binary"


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (an add, then two multiply-and-shift rounds)."""
    h = np.asarray(h).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _fractions(h: np.ndarray, *salts: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit values and salts."""
    with np.errstate(over="ignore"):
        for salt in salts:
            h = mix(h ^ mix(np.uint64(salt)))
    return (h >> np.uint64(11)).astype(float) * 2.0**-53


# bins and blocks


def bin_edges(df: DataFrame, columns: list[str], bins: int = BINS) -> list[list[float]]:
    """Upper ends of the bins of each column but the last, from one pass of quantile sketches."""
    shares = [i / bins for i in range(1, bins)]
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    row = df.agg(*[F.percentile_approx(known(c), shares, 10_000).alias(f"e{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(v or [])) for v in row]


def to_bins(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """(row, column) doubles to bin numbers; NaN lies in the last bin."""
    return np.column_stack([np.searchsorted(np.asarray(e), values[:, j]) for j, e in enumerate(edges)]).astype(np.uint8)


def blocks(df: DataFrame, columns: list[str], code: str, weight: str | None, key: str, edges, classes: int) -> DataFrame:
    """Binned rows in blocks, in as many partitions as there are blocks; margins start at zero."""
    numbers = F.array(*[F.col(c).cast("double") for c in columns])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(code).isNotNull()).select(numbers.alias("v"), F.col(code).cast("int").alias("y"), w.alias("w"), F.xxhash64(F.col(key).cast("string")).alias("h"))
    # read twice; callers give rows that are stored
    parts = max(1, -(-rows.count() // BLOCK_ROWS))

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield one(held)
                held, size = [], 0
        if size:
            yield one(held)

    def one(held):
        t = pa.Table.from_batches(held)
        v = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(t.num_rows, len(columns))
        data = [to_bins(v, edges).tobytes()] + [t[c].to_numpy().astype(k).tobytes() for c, k in (("y", "<i4"), ("w", "<f8"), ("h", "<i8"))]
        return _block(t.num_rows, *data, np.zeros((t.num_rows, classes)).tobytes())

    return cut_lineage(rows.repartition(parts).mapInArrow(pack, BLOCK))


def _block(rows, x, y, w, h, margins) -> pa.RecordBatch:
    cells = [pa.array([rows], pa.int32()), *[pa.array([b], pa.binary()) for b in (x, y, w, h, margins)]]
    return pa.RecordBatch.from_arrays(cells, names=["rows", "x", "y", "w", "h", "margins"])


@dataclass
class Rows:
    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    h: np.ndarray
    margins: np.ndarray
    p: np.ndarray | None = None

    @classmethod
    def of(cls, r: dict) -> Rows:
        n = r["rows"]
        return cls(
            np.frombuffer(r["x"], np.uint8).reshape(n, -1),
            np.frombuffer(r["y"], "<i4"),
            np.frombuffer(r["w"], "<f8"),
            np.frombuffer(r["h"], "<i8"),
            np.frombuffer(r["margins"], "<f8").reshape(n, -1).copy(),
        )


# trees


@dataclass
class Tree:
    """Nodes in the order of their making; ``feature`` -1 marks leaves, ``path`` numbers the root 1 and children 2p, 2p+1."""

    number: int
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])
    path: list[int] = field(default_factory=lambda: [1])
    sums: list[list[float]] = field(default_factory=lambda: [[]])
    open: list[int] = field(default_factory=lambda: [0])

    def route(self, x: np.ndarray, depth: int | None = None, at: np.ndarray | None = None, done: int = 0) -> np.ndarray:
        """Node of every row, not deeper than ``depth``; rows may be ``at`` nodes of the depth ``done`` already."""
        feature, cut, left = (np.asarray(a) for a in (self.feature, self.cut, self.left))
        at = np.zeros(len(x), dtype=np.int64) if at is None else at
        everyone = np.arange(len(x))
        deepest = int(np.max(self.depth))
        for _ in range(done, deepest if depth is None else min(depth, deepest)):
            f = feature[at]
            right = x[everyone, np.maximum(f, 0)] > cut[at]
            at = np.where(f >= 0, left[at] + right, at)
        return at

    def split(self, node: int, feature: int, cut: int, gain: float, sides) -> None:
        self.feature[node], self.cut[node], self.gain[node], self.left[node] = feature, cut, gain, len(self.feature)
        for side, sums in enumerate(sides):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.gain.append(0.0)
            self.depth.append(self.depth[node] + 1)
            self.path.append(2 * self.path[node] + side)
            self.sums.append(list(sums))
            self.open.append(len(self.feature) - 1)

    def graft(self, node: int, sub: Tree) -> None:
        """Put a tree that was grown from a node's rows in its place; the node keeps its sums."""
        base, sub = len(self.feature) - 1, Tree(**{k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in vars(sub).items()})
        lefts = [left + base if f >= 0 else -1 for f, left in zip(sub.feature, sub.left, strict=True)]
        self.feature[node], self.cut[node], self.gain[node], self.left[node] = sub.feature[0], sub.cut[0], sub.gain[0], lefts[0]
        self.left += lefts[1:]
        for name in ("feature", "cut", "gain", "depth", "path", "sums"):
            getattr(self, name).extend(getattr(sub, name)[1:])

    def by_level(self) -> Tree:
        """The same tree with its nodes in the order of a growth level by level."""
        order = [0]
        for n in order:
            if self.feature[n] >= 0:
                order += [self.left[n], self.left[n] + 1]
        place = {n: i for i, n in enumerate(order)}
        columns = {name: [getattr(self, name)[n] for n in order] for name in ("feature", "cut", "gain", "depth", "path", "sums")}
        lefts = [place[self.left[n]] if self.feature[n] >= 0 else -1 for n in order]
        return Tree(self.number, left=lefts, open=[], **columns)


@dataclass(frozen=True)
class Growth:
    """How trees grow. ``targets`` is the width of G; features are drawn for each node or for each tree."""

    depth: int
    targets: int
    features: int
    drawn: int
    per_node: bool
    least_rows: float = 1.0
    least_weight: float = 0.0
    penalty: float = 0.0
    seed: int = SEED
    bins: int = BINS

    def candidates(self, tree: int, path: int) -> np.ndarray:
        return self.all_candidates(tree, [path])[0]

    def all_candidates(self, tree: int, paths: list[int]) -> np.ndarray:
        """The features drawn for some nodes of a tree, a row each."""
        if self.drawn >= self.features:
            return np.tile(np.arange(self.features), (len(paths), 1))
        last = np.array(paths if self.per_node else [0] * len(paths), dtype=np.uint64)
        with np.errstate(over="ignore"):
            h = np.arange(self.features, dtype=np.uint64)
            for salt in (self.seed, tree):
                h = mix(h ^ mix(np.uint64(salt)))
            h = mix(h[None, :] ^ mix(last)[:, None])
        order = np.argsort((h >> np.uint64(11)).astype(float) * 2.0**-53, axis=1, kind="stable")
        return np.sort(order[:, : self.drawn], axis=1)

    def score(self, sums: np.ndarray) -> np.ndarray:
        g, h = sums[..., : self.targets], sums[..., self.targets] + self.penalty
        return np.divide((g * g).sum(axis=-1), h, out=np.zeros(h.shape), where=h > 0)

    def histograms(self, x, stats, node, count, chosen) -> np.ndarray:
        """Sums by (open node, candidate, bin); ``node`` numbers the rows' open nodes, ``chosen`` lists their candidates."""
        k, size, everyone = chosen.shape[1], count * self.bins, np.arange(len(x))
        total, columns = np.empty((count, k, self.bins, stats.shape[1])), [np.ascontiguousarray(s) for s in stats.T]
        shared = not self.per_node or self.drawn >= self.features
        # a candidate after the other, whose cells stay in the caches
        for c in range(k):
            cells = node * self.bins + (x[:, chosen[0, c]] if shared else x[everyone, chosen[node, c]])
            for j, s in enumerate(columns):
                total[:, c, :, j] = np.bincount(cells, s, size).reshape(count, self.bins)
        return total

    def best(self, hist: np.ndarray, chosen: np.ndarray):
        """Per open node: candidate feature, cut, gain and the sums of both sides; a gain of 0 means no split."""
        left = hist.cumsum(axis=2)
        total = left[:, :1, -1:, :]
        left = left[:, :, :-1]
        right = total - left
        gain = self.score(left) + self.score(right) - self.score(total)
        t = self.targets
        fits = np.minimum(left[..., t + 1], right[..., t + 1]) >= self.least_rows - 1e-9
        fits &= np.minimum(left[..., t], right[..., t]) >= max(self.least_weight, 1e-12)
        gain = np.where(fits & (gain > 1e-10 * (1.0 + np.abs(self.score(total)))), gain, 0.0)
        flat = gain.reshape(len(hist), -1)
        at = flat.argmax(axis=1)
        i, j, b = np.arange(len(hist)), at // gain.shape[2], at % gain.shape[2]
        return chosen[i, j], b, flat[i, at], left[i, j, b], right[i, j, b]

    def best_of_rows(self, x, stats, node, count, chosen):
        """``best`` of the rows' histograms without these, for nodes of few rows; the same if all sums are whole numbers."""
        k = chosen.shape[1]
        key = ((node[:, None] * k + np.arange(k)) * self.bins + x[np.arange(len(x))[:, None], chosen[node]]).ravel()
        order = np.argsort(key, kind="stable")
        key, running = key[order], np.cumsum(stats[order // k], axis=0)
        group = key // self.bins
        first = np.searchsorted(group, np.arange(count * k))
        before = np.where(first[:, None] > 0, running[first - 1], 0.0)
        total = running[np.append(first[1:], len(key)) - 1] - before
        ends = np.flatnonzero((key[1:] != key[:-1]) & (group[1:] == group[:-1]))
        of = group[ends]
        left = running[ends] - before[of]
        right = total[of] - left
        whole = self.score(total)[of]
        gain = self.score(left) + self.score(right) - whole
        t = self.targets
        fits = np.minimum(left[:, t + 1], right[:, t + 1]) >= self.least_rows - 1e-9
        fits &= np.minimum(left[:, t], right[:, t]) >= max(self.least_weight, 1e-12)
        ok = np.flatnonzero(fits & (gain > 1e-10 * (1.0 + np.abs(whole))))
        ok = ok[np.lexsort((-gain[ok], of[ok] // k))]
        ok = ok[np.unique(of[ok] // k, return_index=True)[1]]
        at = of[ok] // k
        feature, cut, most = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count)
        low, high = np.zeros((count, stats.shape[1])), np.zeros((count, stats.shape[1]))
        feature[at], cut[at], most[at] = chosen[at, of[ok] % k], key[ends[ok]] % self.bins, gain[ok]
        low[at], high[at] = left[ok], right[ok]
        return feature, cut, most, low, high

    def _gains(self, left: list[np.ndarray], total: list[np.ndarray]) -> np.ndarray:
        """Gain of cuts, 0 where they may not be made, from the counts of each class; ``best`` for unit weights."""
        sides = left, [n - low for low, n in zip(left, total, strict=True)], total
        sizes = [sum(side[1:], side[0]) for side in sides]
        squares = [sum((g * g for g in side[1:]), side[0] * side[0]) for side in sides]
        scores = [np.divide(g, h, out=np.zeros(h.shape), where=h > 0) for g, h in zip(squares, sizes, strict=True)]
        gain = scores[0] + scores[1] - scores[2]
        fits = np.minimum(sizes[0], sizes[1]) >= max(self.least_rows - 1e-9, self.least_weight, 1e-12)
        return np.where(fits & (gain > 1e-10 * (1.0 + np.abs(scores[2]))), gain, 0.0)

    def _dense_splits(self, cells, y, draws, local, totals) -> tuple:
        """Best split of each node of many rows: a histogram of class counts for one candidate after the other.

        ``cells(c)`` gives the rows' bins of their node's candidate c, ``local`` their nodes.
        """
        m, t = totals.shape
        feature, cut, most, low = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m), np.zeros((m, t))
        first, whole = (y * m + local) * self.bins, [n[:, None] for n in totals.T.astype(float)]
        for c in range(self.drawn):
            hist = np.bincount(first + cells(c), draws, t * m * self.bins).reshape(t, m, self.bins)
            left = hist.cumsum(axis=2)[:, :, :-1]
            gain = self._gains(list(left), whole)
            at = gain.argmax(axis=1)
            top = gain[np.arange(m), at]
            more = np.flatnonzero(top > most)
            feature[more], cut[more], most[more], low[more] = c, at[more], top[more], left[:, more, at[more]].T
        return feature, cut, most, low

    def _sparse_splits(self, cells, y, draws, local, totals) -> tuple:
        """``_dense_splits`` for nodes of few rows: only cuts behind a bin that has rows, in the order of one sort."""
        (m, t), k = totals.shape, self.drawn
        packed = np.stack([(((local * k + c) * self.bins + cells(c)) * t + y << 5) | draws for c in range(k)])
        packed = np.sort(packed.astype(np.uint32).ravel())
        draws, packed = (packed & 31).astype(np.int64), packed >> 5
        cell, y = packed // t, packed % t
        group = cell // self.bins
        ends = np.flatnonzero((cell[1:] != cell[:-1]) & (group[1:] == group[:-1]))
        node, c = np.divmod(group[ends].astype(np.int64), k)
        earlier = totals.cumsum(axis=0) - totals
        left = [np.cumsum(np.where(y == j, draws, 0))[ends] - (k * earlier[node, j] + c * totals[node, j]) for j in range(t)]
        gain = self._gains([n.astype(float) for n in left], [totals[node, j].astype(float) for j in range(t)])
        ok = np.flatnonzero(gain > 0)
        feature, cut, most, low = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m), np.zeros((m, t))
        if len(ok):
            of = node[ok]
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            top = np.repeat(np.maximum.reduceat(gain[ok], first), np.diff(np.append(first, len(ok))))
            ok = ok[gain[ok] == top]
            ok = ok[np.append(True, node[ok][1:] != node[ok][:-1])]
            at = node[ok]
            feature[at], cut[at], most[at], low[at] = c[ok], cell[ends[ok]] % self.bins, gain[ok], np.stack([n[ok] for n in left], axis=1)
        return feature, cut, most, low

    def grow_counts(self, number: int, x: np.ndarray, y: np.ndarray, draws: np.ndarray, path: int = 1, depth: int = 0) -> Tree:
        """``grow`` of a tree on class counts where all weights are one: the same tree from ``draws`` of each row.

        Rows are kept in the order of their nodes and leave with them, so that a node's rows lie together.
        """
        t, bins = self.targets, self.bins
        used = draws > 0
        x, y, draws = x[used], y[used].astype(np.int64), draws[used].astype(np.int64)
        totals = np.bincount(y, draws, t)[None, :]
        paths, at, size = np.array([path], dtype=np.int64), np.zeros(len(x), np.int64), 1
        made: dict[str, list] = {"feature": [np.array([-1])], "cut": [np.array([0])], "left": [np.array([-1])], "gain": [np.array([0.0])], "depth": [np.array([depth])], "path": [paths], "counts": [totals]}
        for level in range(self.depth):
            going = totals.sum(axis=1) >= 2 * self.least_rows
            if not going.any():
                break
            place = np.cumsum(going) - 1
            keep = np.flatnonzero(going[at])
            x, y, draws, at = x[keep], y[keep], draws[keep], place[at[keep]]
            nodes, totals = np.flatnonzero(going), totals[going]
            ends = np.searchsorted(at, np.arange(len(nodes) + 1))
            chosen = self.all_candidates(number, paths[going])
            found = []
            # packed into 32 bits, and histograms of a bounded size
            step = max(1, min((1 << 32) // (self.drawn * bins * t * 32) - 1, CELLS // (2 * bins * t)))
            begin = 0
            while begin < len(nodes):
                # as many rows as a few at once, but one node at least
                end = max(begin + 1, min(begin + step, int(np.searchsorted(ends, ends[begin] + COUNTED_ROWS, "right")) - 1))
                end = min(end, len(nodes))
                rows = slice(ends[begin], ends[end])
                local = at[rows] - begin
                flat, row, drawn = x[rows].ravel(), np.arange(ends[end] - ends[begin]) * x.shape[1], chosen[begin:end].T.copy()
                cells = lambda c, flat=flat, row=row, drawn=drawn, local=local: flat[row + drawn[c][local]].astype(np.int64)
                splits = self._dense_splits if len(row) > DENSE_ROWS * (end - begin) else self._sparse_splits
                found.append(splits(cells, y[rows], draws[rows], local, totals[begin:end]))
                begin = end
            which, cut, gain, low = (np.concatenate(parts) for parts in zip(*found, strict=True))
            feature = chosen[np.arange(len(nodes)), which]
            split = gain > 0
            rank, n = np.cumsum(split) - 1, int(split.sum())
            for name, v in (("feature", np.where(split, feature, -1)), ("cut", np.where(split, cut, 0)), ("left", np.where(split, size + 2 * rank, -1)), ("gain", gain)):
                made[name][-1][nodes] = v
            if not n:
                break
            sides = np.stack([low[split], totals[split] - low[split]], axis=1).reshape(2 * n, t)
            paths = (2 * paths[going][split][:, None] + np.arange(2)).ravel()
            keep = np.flatnonzero(split[at])
            x, y, draws, at = x[keep], y[keep], draws[keep], at[keep]
            right = x.ravel()[np.arange(len(x)) * x.shape[1] + feature[at]] > cut[at]
            at = 2 * rank[at] + right
            order = np.argsort(at, kind="stable")
            x, y, draws, at, totals = x[order], y[order], draws[order], at[order], sides
            size += 2 * n
            fresh = {"feature": np.full(2 * n, -1), "cut": np.zeros(2 * n, np.int64), "left": np.full(2 * n, -1), "gain": np.zeros(2 * n), "depth": np.full(2 * n, depth + level + 1), "path": paths, "counts": sides}
            for name, v in fresh.items():
                made[name].append(v)
        columns = {name: np.concatenate(parts) for name, parts in made.items()}
        counts = columns.pop("counts")
        n = counts.sum(axis=1, keepdims=True)
        return Tree(number, open=[], sums=np.concatenate([counts, n, n], axis=1).astype(float), **columns)

    def grow_rows(self, start: Tree, x: np.ndarray, stats: np.ndarray) -> Tree:
        """``grow``, or the same by ``grow_counts`` where every row counts for one class."""
        t = self.targets
        plain = self.penalty == 0 and start.path[0] >> max(0, 62 - self.depth) == 0
        if plain and stats.dtype == np.uint8 and (stats[:, -1] < 32).all() and (stats[:, :t].max(axis=1, initial=0) == stats[:, t]).all():
            if (stats[:, t] == stats[:, -1]).all() and (np.count_nonzero(stats[:, :t], axis=1) <= 1).all():
                return self.grow_counts(start.number, x, stats[:, :t].argmax(axis=1), stats[:, -1], start.path[0], start.depth[0])
        return self.grow(start, x, stats.astype(float))

    def may_split(self, sums: list[float]) -> bool:
        return sums[self.targets + 1] >= 2 * self.least_rows

    def grow(self, tree: Tree, x: np.ndarray, stats: np.ndarray) -> Tree:
        """The whole tree from rows at hand."""
        tree.sums[0] = stats.sum(axis=0).tolist()
        used = stats[:, -1] > 0
        x, stats = x[used], stats[used]
        whole = bool((stats == np.rint(stats)).all())
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            going = [n for n in tree.open if self.may_split(tree.sums[n])]
            tree.open = []
            if not going:
                break
            step = max(1, CELLS // (self.drawn * self.bins * stats.shape[1]))
            place = np.full(len(tree.feature), -1)
            for begin in range(0, len(going), step):
                some = going[begin : begin + step]
                place[:] = -1
                place[some] = np.arange(len(some))
                rows = np.flatnonzero(place[at] >= 0)
                chosen = self.all_candidates(tree.number, [tree.path[n] for n in some])
                given = x[rows], stats[rows], place[at[rows]], len(some), chosen
                few = whole and 2 * len(rows) < len(some) * self.bins
                _divide(tree, some, self.best_of_rows(*given) if few else self.best(self.histograms(*given), chosen))
            feature, cut, left = (np.asarray(a) for a in (tree.feature, tree.cut, tree.left))
            f = feature[at]
            at = np.where(f >= 0, left[at] + (x[np.arange(len(x)), np.maximum(f, 0)] > cut[at]), at)
        tree.open = []
        return tree


def _divide(tree: Tree, nodes: list[int], found) -> None:
    for node, f, b, gain, *sides in zip(nodes, *found, strict=True):
        if gain > 0:
            tree.split(node, int(f), int(b), float(gain), [s.tolist() for s in sides])


def grow_all(data: DataFrame, growth: Growth, trees: list[Tree], stats_of, groups: int = 64) -> None:
    """Grow trees over many blocks, one aggregation for each level and each batch of open nodes that a task can hold.

    ``stats_of(rows, tree number)`` gives the rows' G columns, H and count in that tree. Nodes of at most a block of rows
    wait until no larger one is open and are then grown to their ends, each where its rows meet.
    """
    few = _upper(data, growth, trees, stats_of, groups)
    if few:
        grown = data.sparkSession.sparkContext.broadcast([Tree(**vars(t)) for t in trees])
        for r in _below(data, growth, grown, few, stats_of).collect():
            trees[r["i"]].graft(r["n"], _unpickled(r["sub"]))
        grown.unpersist()
        for t in trees:
            vars(t).update(vars(t.by_level()))


def _upper(data: DataFrame, growth: Growth, trees: list[Tree], stats_of, groups: int = 64) -> list[tuple[int, int]]:
    """Grow the nodes of more than a block of rows; returns the open ones that are left (place of the tree, node)."""
    width = growth.targets + 2
    wanted = max(1, CELLS // (growth.drawn * growth.bins * width))
    spark = data.sparkSession
    for r in _summed(data, [t.number for t in trees], stats_of):
        next(t for t in trees if t.number == r["tree"]).sums[0] = r["sums"]
    few: list[tuple[int, int]] = []
    for _ in range(growth.depth):
        going = [(i, n) for i, t in enumerate(trees) for n in t.open if growth.may_split(t.sums[n])]
        few += [(i, n) for i, n in going if trees[i].sums[n][growth.targets + 1] <= BLOCK_ROWS]
        going = [(i, n) for i, n in going if trees[i].sums[n][growth.targets + 1] > BLOCK_ROWS]
        for t in trees:
            t.open = []
        if not going:
            break
        grown = spark.sparkContext.broadcast([Tree(**vars(t)) for t in trees])
        done = []
        for begin in range(0, len(going), wanted):
            some = going[begin : begin + wanted]
            done.append((some, _level(data, growth, grown, some, stats_of, groups)))
        for some, found in done:
            for at, (i, n) in enumerate(some):
                if at in found:
                    f, b, gain, left, right = found[at]
                    trees[i].split(n, f, b, gain, [left, right])
        grown.unpersist()
    for t in trees:
        t.open = []
    return few


def _unpickled(data: bytes):
    import pickle

    return pickle.loads(data)


def _below(data: DataFrame, growth: Growth, grown, few: list[tuple[int, int]], stats_of) -> DataFrame:
    """i, n, sub: what grows below some nodes, from their rows, which are sent to a group for each node.

    Sums that are whole numbers travel as bytes.
    """
    import pickle

    by_tree: dict[int, list[int]] = {}
    for i, n in few:
        by_tree.setdefault(i, []).append(n)
    columns = growth.targets + 2

    def send(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = Rows.of(r)
                for i, nodes in by_tree.items():
                    tree = grown.value[i]
                    stats, place = stats_of(rows, tree.number), np.full(len(tree.feature), len(nodes))
                    place[nodes] = np.arange(len(nodes))
                    here = np.where(stats[:, -1] > 0, place[tree.route(rows.x)], len(nodes))
                    order = np.argsort(here, kind="stable")
                    ends = np.searchsorted(here[order], np.arange(len(nodes) + 1))
                    for k, n in enumerate(nodes):
                        at = order[ends[k] : ends[k + 1]]
                        if len(at):
                            some = stats[at]
                            small = some.astype(np.uint8) if ((some >= 0) & (some < 256)).all() else some
                            some = small if (small == some).all() else some
                            cells = [pa.array([v]) for v in (i, n)] + [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (rows.x[at], some)]
                            yield pa.RecordBatch.from_arrays(cells, names=["i", "n", "x", "stats"])

    def grow(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, n = (k.as_py() for k in key)
        given = [r for batch in batches for r in batch.to_pylist()]
        x = np.frombuffer(b"".join(r["x"] for r in given), np.uint8).reshape(-1, growth.features)
        stats = [np.frombuffer(r["stats"], np.uint8 if len(r["stats"]) * growth.features == columns * len(r["x"]) else "<f8").reshape(-1, columns) for r in given]
        tree = grown.value[i]
        start = Tree(tree.number, depth=[tree.depth[n]], path=[tree.path[n]])
        sub = replace(growth, depth=growth.depth - tree.depth[n]).grow_rows(start, x, np.concatenate(stats))
        vars(sub).update({k: np.asarray(v) for k, v in vars(sub).items() if k != "number"})
        yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([n]), pa.array([pickle.dumps(sub)], pa.binary())], names=["i", "n", "sub"])

    sent = data.mapInArrow(send, "i long, n long, x binary, stats binary")
    # few groups with much to do: more partitions than groups, so that hardly any task gets several
    sent = sent.repartition(min(4 * len(few), 1024), "i", "n")
    return sent.groupBy("i", "n").applyInArrow(grow, "i long, n long, sub binary")


def _summed(data: DataFrame, numbers: list[int], stats_of) -> list[dict]:
    def sums(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = Rows.of(r)
                totals = [stats_of(rows, t).sum(axis=0).tolist() for t in numbers]
                yield pa.RecordBatch.from_pydict({"tree": numbers, "sums": totals})

    parts = data.mapInArrow(sums, "tree long, sums array<double>").select("tree", F.posexplode("sums").alias("i", "s"))
    summed = parts.groupBy("tree", "i").agg(F.sum("s").alias("s")).groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("l"))
    return [r.asDict() for r in summed.select("tree", F.col("l.s").alias("sums")).collect()]


def _level(data: DataFrame, growth: Growth, grown, some, stats_of, groups: int) -> dict:
    """Best splits of some open nodes, by their place in the list."""
    share = max(1, -(-len(some) // groups))
    by_tree: dict[int, list[tuple[int, int]]] = {}
    for at, (i, n) in enumerate(some):
        by_tree.setdefault(i, []).append((at, n))

    def chosen_of(first: int, count: int) -> np.ndarray:
        return np.array([growth.candidates(grown.value[i].number, grown.value[i].path[n]) for i, n in some[first : first + count]])

    def count(batches):
        total = np.zeros((len(some), growth.drawn, growth.bins, growth.targets + 2))
        for batch in batches:
            for r in batch.to_pylist():
                rows = Rows.of(r)
                for i, nodes in by_tree.items():
                    tree = grown.value[i]
                    place = np.full(len(tree.feature), -1)
                    place[[n for _, n in nodes]] = np.arange(len(nodes))
                    here = place[tree.route(rows.x)]
                    at = np.flatnonzero(here >= 0)
                    if len(at):
                        stats = stats_of(rows, tree.number)[at]
                        first = nodes[0][0]
                        hist = growth.histograms(rows.x[at], stats, here[at], len(nodes), chosen_of(first, len(nodes)))
                        total[first : first + len(nodes)] += hist
        for first in range(0, len(some), share):
            part = total[first : first + share]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([part.tobytes()], pa.binary())], names=["first", "data"])

    def choose(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total = key[0].as_py(), None
        for batch in batches:
            for data_ in batch.column("data"):
                part = np.frombuffer(data_.as_py(), "<f8")
                total = part.copy() if total is None else total + part
        hist = total.reshape(-1, growth.drawn, growth.bins, growth.targets + 2)
        f, b, gain, left, right = growth.best(hist, chosen_of(first, len(hist)))
        keep = np.flatnonzero(gain > 0)
        out = {"at": keep + first, "feature": f[keep], "cut": b[keep], "gain": gain[keep]}
        cells = [pa.array(np.asarray(v)) for v in out.values()] + [pa.array(s[keep].tolist(), pa.list_(pa.float64())) for s in (left, right)]
        yield pa.RecordBatch.from_arrays(cells, names=[*out, "low", "high"])

    schema = "at long, feature long, cut long, gain double, low array<double>, high array<double>"
    # every task sends the histograms of all nodes, so that there are as many as keep the cores busy
    fewer = data.coalesce(2 * data.sparkSession.sparkContext.defaultParallelism)
    rows = fewer.mapInArrow(count, "first long, data binary").groupBy("first").applyInArrow(choose, schema).collect()
    return {r["at"]: (r["feature"], r["cut"], r["gain"], r["low"], r["high"]) for r in rows}


# models


@dataclass
class Ensemble:
    """Fitted trees: votes of a forest, or rounds of boosting with one tree for each class."""

    kind: str
    classes: int
    edges: list[list[float]]
    trees: list[Tree]
    step: float = 0.0
    penalty: float = 0.0

    def _per(self) -> int:
        """Trees of one unit of size: a round of boosting has one for each class."""
        return self.classes if self.kind == "boosted" else 1

    def margins(self, x: np.ndarray, rounds: int | None = None) -> np.ndarray:
        total = np.zeros((len(x), self.classes))
        for t in self.trees if rounds is None else self.trees[: rounds * self.classes]:
            total[:, t.number % self.classes] += self._leaf(t)[t.route(x)]
        return total

    def _leaf(self, t: Tree) -> np.ndarray:
        s = np.asarray(t.sums)
        return -self.step * s[:, 0] / (s[:, 1] + self.penalty)

    def votes(self, x: np.ndarray, trees: int | None = None, depth: int | None = None) -> np.ndarray:
        """Sum of the trees' class shares."""
        total = np.zeros((len(x), self.classes))
        for t in self.trees[:trees]:
            total += self.shares(t)[t.route(x, depth)]
        return total

    def shares(self, t: Tree) -> np.ndarray:
        """Class shares of a tree's nodes."""
        s = np.asarray(t.sums)[:, : self.classes]
        n = s.sum(axis=1, keepdims=True)
        # a bootstrap sample may leave a tree without rows
        return np.divide(s, n, out=np.full(s.shape, 1.0 / self.classes), where=n > 0)

    def probabilities(self, x: np.ndarray, size: int | None = None, depth: int | None = None) -> np.ndarray:
        """Class probabilities of binned rows, by the first ``size`` trees or rounds."""
        if self.kind == "boosted":
            return softmax(self.margins(x, size))
        return self.votes(x, size, depth) / len(self.trees[:size])

    def probability(self, features):
        """Column of class probabilities from a column of feature arrays."""

        @F.pandas_udf("array<double>")
        def score(v):
            import pandas as pd

            values = np.array([np.asarray(a, dtype=float) for a in v]).reshape(len(v), len(self.edges))
            return pd.Series(list(self.probabilities(to_bins(values, self.edges))))

        return score(features)

    def importances(self) -> np.ndarray:
        """Mean gain of the splits on each feature, scaled to sum to one."""
        total, splits = np.zeros(len(self.edges)), np.zeros(len(self.edges))
        for t in self.trees:
            f = np.asarray(t.feature)
            np.add.at(total, f[f >= 0], np.asarray(t.gain)[f >= 0])
            np.add.at(splits, f[f >= 0], 1)
        mean = np.divide(total, splits, out=np.zeros_like(total), where=splits > 0)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (t.number, n, f, c, left, gain, depth, p, s)
            for t in self.trees
            for n, (f, c, left, gain, depth, p, s) in enumerate(zip(t.feature, t.cut, t.left, t.gain, t.depth, t.path, t.sums, strict=True))
        ]
        schema = "tree int, node int, feature int, cut int, left int, gain double, depth int, path long, sums array<double>"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = {"kind": self.kind, "classes": self.classes, "edges": self.edges, "step": self.step, "penalty": self.penalty}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        found: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/nodes").collect():
            found.setdefault(r["tree"], []).append(r)
        trees = []
        for number in sorted(found):
            nodes = sorted(found[number], key=lambda r: r["node"])
            columns = {c: [r[c] for r in nodes] for c in ("feature", "cut", "left", "gain", "depth", "path", "sums")}
            trees.append(Tree(number, **columns, open=[]))
        return cls(meta["kind"], meta["classes"], meta["edges"], trees, meta["step"], meta["penalty"])


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _poisson(h: np.ndarray, *salts: int) -> np.ndarray:
    """Draws from the Poisson distribution of mean 1: how often a row stands in a bootstrap sample."""
    u, draws, share, below = _fractions(h.view(np.uint64), *salts), np.zeros(len(h)), math.exp(-1.0), math.exp(-1.0)
    for k in range(1, 20):
        draws += u >= below
        share /= k
        below += share
    return draws


def _forest(edges, classes: int, depth: int, least_rows: int, seed: int):
    """How the trees of a forest grow: on class counts, with the root of the number of features drawn for each node."""
    drawn = max(1, math.ceil(math.sqrt(len(edges))))
    growth = Growth(depth, classes, len(edges), drawn, True, least_rows, seed=seed)

    def stats_of(rows: Rows, number: int) -> np.ndarray:
        draws = _poisson(rows.h, seed, number)
        w = draws * rows.w
        return np.column_stack([*[w * (rows.y == c) for c in range(classes)], w, draws])

    return growth, stats_of


def _whole_tree(growth: Growth, rows: Rows, number: int, stats_of) -> Tree:
    """A tree of a forest from all rows."""
    plain = bool((rows.w == 1).all()) and len(rows.y) > 0 and 0 <= rows.y.min() <= rows.y.max() < growth.targets
    if plain and growth.depth <= 60:  # paths are 64-bit numbers there
        return growth.grow_counts(number, rows.x, rows.y, _poisson(rows.h, growth.seed, number))
    return growth.grow(Tree(number), rows.x, stats_of(rows, number))


def _kept(data: DataFrame) -> str:
    """Where the blocks lie for tasks that read all of them, in the shared folder."""
    path = scratch_path(data.sparkSession, "table")
    data.select("rows", "x", "y", "w", "h").write.parquet(path)
    return path


def _read_rows(path: str) -> Rows:
    """All rows of a few blocks that were kept, as one."""
    found = [Rows.of({**r, "margins": b""}) for r in _read_parquet(path, ["rows", "x", "y", "w", "h"])]
    if not found:
        return Rows(np.zeros((0, 1), np.uint8), np.zeros(0, "<i4"), np.zeros(0), np.zeros(0, "<i8"), np.zeros((0, 0)))
    return Rows(*[np.concatenate([getattr(r, name) for r in found]) for name in ("x", "y", "w", "h", "margins")])


def _read_parquet(path: str, columns: list[str]) -> Iterator[dict]:
    from pyarrow import fs, parquet

    store, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    for info in sorted(store.get_file_info(fs.FileSelector(place)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            yield from parquet.ParquetFile(store.open_input_file(info.path)).read(columns).to_pylist()


def _tasks(spark: SparkSession, parts: int) -> DataFrame:
    """``part``: a task for each number."""
    return spark.range(0, parts, 1, parts).select(F.col("id").alias("part"))


def _grown(data: DataFrame, growth: Growth, stats_of, trees: int) -> DataFrame:
    """The trees (``NODES``) over a table of up to ``TABLE_BLOCKS`` blocks, dealt to tasks, each of which reads the table."""
    spark, path = data.sparkSession, _kept(data)
    parts = min(trees, 4 * spark.sparkContext.defaultParallelism)

    def some(batches):
        for batch in batches:
            for part in batch.column("part").to_pylist():
                rows = _read_rows(path)
                for t in range(part, trees, parts):
                    yield _nodes(_whole_tree(growth, rows, t, stats_of))

    return _tasks(spark, parts).mapInArrow(some, NODES)


def fit_forest(data: DataFrame, edges, classes: int, trees: int, depth: int, least_rows: int, seed: int = SEED) -> Ensemble:
    """Bagged trees."""
    growth, stats_of = _forest(edges, classes, depth, least_rows, seed)
    if data.count() > TABLE_BLOCKS:
        grown = [Tree(t) for t in range(trees)]
        grow_all(data, growth, grown, stats_of)
        return Ensemble("forest", classes, edges, grown)
    return Ensemble("forest", classes, edges, _collected(_grown(data, growth, stats_of, trees)))


class StoredForest:
    """A forest whose trees stay in the shared folder until something of the ensemble is asked for."""

    def __init__(self, classes: int, edges, rows: DataFrame):
        self.classes, self.edges, self.rows, self.whole = classes, edges, rows, None

    def __getattr__(self, name):
        if name.startswith("__"):
            raise AttributeError(name)
        if self.whole is None:
            self.whole = Ensemble("forest", self.classes, self.edges, _collected(self.rows))
        return getattr(self.whole, name)


def stored_forest(data: DataFrame, edges, classes: int, trees: int, depth: int, least_rows: int, seed: int = SEED) -> Ensemble | StoredForest:
    """``fit_forest`` without its trees at the driver."""
    path = scratch_path(data.sparkSession, "forest")
    _in_tasks(data, *_forest(edges, classes, depth, least_rows, seed), trees).write.option("compression", "zstd").parquet(path)
    return StoredForest(classes, edges, data.sparkSession.read.schema(NODES).parquet(path))


class TaskForest:
    """A forest whose trees stay in the shared folder, a folder each; rows are scored and importances made in tasks.

    A task reads one tree after the other for every block of rows it scores, so it holds a tree and a block at a time.
    """

    def __init__(self, spark: SparkSession, path: str, classes: int, edges: list[list[float]], trees: int):
        self.spark, self.path, self.classes, self.edges, self.trees = spark, path, classes, edges, trees

    @classmethod
    def fit(cls, data: DataFrame, edges, classes: int, trees: int, depth: int, least_rows: int, seed: int = SEED) -> TaskForest:
        """The trees of ``fit_forest``; over many blocks each is put together from its parts in a task."""
        growth, stats_of = _forest(edges, classes, depth, least_rows, seed)
        spark, path = data.sparkSession, scratch_path(data.sparkSession, "forest")
        whole = _in_tasks(data, growth, stats_of, trees)

        def lean(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    yield _lean(r["tree"], _unpickled(r["columns"]), classes)

        whole.mapInArrow(lean, NODES).write.partitionBy("tree").option("compression", "zstd").parquet(path)
        return cls(spark, path, classes, edges, trees)

    def transform(self, df: DataFrame, features: Column, name: str) -> DataFrame:
        """Append the class probabilities of a column of feature arrays; a narrow pass."""
        path, classes, edges, trees = self.path, self.classes, self.edges, self.trees

        def score(batches):
            held, size = [], 0
            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                if size >= BLOCK_ROWS:
                    yield from one(held)
                    held, size = [], 0
            if size:
                yield from one(held)

        def one(held):
            t = pa.Table.from_batches(held)
            v = t["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(t.num_rows, len(edges))
            x, total = to_bins(v, edges), np.zeros((t.num_rows, classes))
            for tree in _read_trees(path, trees):
                total += tree["share"][_routed(tree, x)]
            cells = pa.ListArray.from_arrays(pa.array(np.arange(t.num_rows + 1, dtype=np.int32) * classes), pa.array((total / trees).ravel()))
            yield from t.drop_columns(["_v"]).append_column(name, cells).to_batches()

        schema = StructType([*df.schema.fields, StructField(name, ArrayType(DoubleType()))])
        return df.withColumn("_v", features).mapInArrow(score, schema)

    def importances(self) -> np.ndarray:
        """Gain of the splits on each feature, as a share of its tree's, averaged over the trees (as the Spark ML forest does)."""
        width = len(self.edges)

        def shares(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    tree = _unpickled(r["columns"])
                    f = tree["feature"]
                    total = np.bincount(f[f >= 0], tree["gain"][f >= 0], width)
                    share = total / total.sum() if total.sum() > 0 else total
                    yield pa.RecordBatch.from_arrays([pa.array([r["tree"]]), pa.array([share.tolist()], pa.list_(pa.float64()))], names=["tree", "share"])

        # a few numbers for each tree
        found = sorted(self._rows().mapInArrow(shares, "tree long, share array<double>").collect())
        mean = np.sum([r["share"] for r in found], axis=0)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(NODES).parquet(self.path)

    def save(self, path: str) -> None:
        self._rows().write.partitionBy("tree").mode("overwrite").parquet(f"{path}/trees")
        meta = json.dumps({"classes": self.classes, "edges": self.edges, "trees": self.trees})
        self.spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TaskForest:
        return cls(spark, f"{path}/trees", **json.loads(spark.read.text(f"{path}/meta").first()["value"]))


def _in_tasks(data: DataFrame, growth: Growth, stats_of, trees: int) -> DataFrame:
    """The trees (``NODES``), none of them at the driver."""
    return (_put_together if data.count() > TABLE_BLOCKS else _grown)(data, growth, stats_of, trees)


def _put_together(data: DataFrame, growth: Growth, stats_of, trees: int) -> DataFrame:
    """The trees (``NODES``) over many blocks: upper nodes from histograms, the rest where rows meet, a group for each tree.

    A tree sends nearly all rows, so only those of ``SENT_TREES`` trees are sent at a time and dropped before the next.
    """
    spark, upper = data.sparkSession, [Tree(t) for t in range(trees)]
    few = _upper(data, growth, upper, stats_of)
    grown = spark.sparkContext.broadcast([Tree(**vars(t)) for t in upper])
    subs = spark.createDataFrame([(i, -1, None) for i in range(trees)], "i long, n long, sub binary")
    if few:
        path = scratch_path(spark, "forest-parts")
        for first in range(0, trees, SENT_TREES):
            some = [(i, n) for i, n in few if first <= i < first + SENT_TREES]
            if some:
                _below(data, growth, grown, some, stats_of).write.mode("append").option("compression", "zstd").parquet(path)
                drop_shuffles(spark)
        subs = subs.union(spark.read.schema(subs.schema).parquet(path))

    def join(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**{k: list(v) if isinstance(v, list) else v for k, v in vars(grown.value[key[0].as_py()]).items()})
        for batch in batches:
            for r in batch.to_pylist():
                if r["sub"] is not None:
                    tree.graft(r["n"], _unpickled(r["sub"]))
        yield _nodes(tree.by_level())

    return subs.repartition(min(trees, 4 * spark.sparkContext.defaultParallelism), "i").groupBy("i").applyInArrow(join, NODES)


def _lean(number: int, tree: dict, classes: int) -> pa.RecordBatch:
    """What scoring and importances need of a tree."""
    import pickle

    s = tree["sums"][:, :classes]
    n = s.sum(axis=1, keepdims=True)
    held = {
        "feature": tree["feature"].astype(np.int16),
        "cut": tree["cut"].astype(np.uint8),
        "left": tree["left"].astype(np.int32),
        "gain": tree["gain"].astype(float),
        "share": np.divide(s, n, out=np.full(s.shape, 1.0 / classes), where=n > 0),
        "depth": int(tree["depth"].max()),
    }
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([pickle.dumps(held)], pa.binary())], names=["tree", "columns"])


def _routed(tree: dict, x: np.ndarray) -> np.ndarray:
    """Leaf of every row."""
    at, everyone = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for _ in range(tree["depth"]):
        f = tree["feature"][at]
        at = np.where(f >= 0, tree["left"][at] + (x[everyone, np.maximum(f, 0)] > tree["cut"][at]), at)
    return at


def _read_trees(path: str, trees: int) -> Iterator[dict]:
    """The stored trees in order, one at a time."""
    for number in range(trees):
        for r in _read_parquet(f"{path}/tree={number}", ["columns"]):
            yield _unpickled(r["columns"])


def forest_hits(data: DataFrame, held: DataFrame, edges, classes: int, leasts: list[int], sizes: list[int], depths: list[int], seed: int = SEED):
    """(right, all) held rows by (size, depth, least rows of a leaf), of forests that vote in the tasks that grow them and go nowhere else.

    Over one block a tree votes by itself; over several the votes of a few trees are summed up before they meet.
    """
    trees, blocks_ = max(sizes), data.count()
    if not 0 < blocks_ <= TABLE_BLOCKS or held.count() > TABLE_BLOCKS:
        found = {least: hits(held, fit_forest(data, edges, classes, trees, max(depths), least, seed), sizes, depths) for least in leasts}
        return {(*k, least): n for least, some in found.items() for k, n in some.items()}
    growing = [_forest(edges, classes, max(depths), least, seed) for least in leasts]
    spark, path, asked_path, model = data.sparkSession, _kept(data), _kept(held), Ensemble("forest", classes, edges, [])
    # runs of trees, none of which goes over a size that is asked for
    ends, step = sorted({0, *sizes}), 1 if blocks_ == 1 else VOTE_TREES
    runs = [(t, min(t + step, end)) for begin, end in zip(ends, ends[1:]) for t in range(begin, end, step)]
    jobs = [(i, run) for run in runs for i in range(len(leasts))]
    parts = min(len(jobs), 4 * spark.sparkContext.defaultParallelism) if step == 1 else len(jobs)

    def vote(batches):
        for batch in batches:
            for part in batch.column("part").to_pylist():
                rows, asked = _read_rows(path), _read_rows(asked_path)
                for i, (first, end) in jobs[part::parts]:
                    total = [np.zeros((len(asked.y), classes)) for _ in depths]
                    for t in range(first, end):
                        tree, node, done = _whole_tree(growing[i][0], rows, t, growing[i][1]), None, 0
                        shares = model.shares(tree)
                        for j in np.argsort(depths).tolist():
                            node, done = tree.route(asked.x, depths[j], node, done), depths[j]
                            total[j] += shares[node]
                    for j, votes in enumerate(total):
                        for at in range(0, len(votes), VOTE_ROWS):
                            cells = [pa.array([v]) for v in (first, i, j, at)]
                            cells += [pa.array([v[at : at + VOTE_ROWS].tobytes()], pa.binary()) for v in (asked.y, votes)]
                            yield pa.RecordBatch.from_arrays(cells, names=["t", "least", "depth", "at", "y", "votes"])

    def count(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(((r["t"], r["y"], r["votes"]) for batch in batches for r in batch.to_pylist()), key=lambda r: r[0])
        y = np.frombuffer(found[0][1], "<i4")
        total, begin = np.zeros((len(y), classes)), 0
        for size in sorted(sizes):
            # summed as a prefix after the other
            part = np.zeros_like(total)
            for _, _, votes in (r for r in found if begin <= r[0] < size):
                part += np.frombuffer(votes, "<f8").reshape(part.shape)
            total, begin = total + part, size
            right = int((total.argmax(axis=1) == y).sum())
            yield pa.RecordBatch.from_pydict({"size": [size], "least": [key[0].as_py()], "depth": [key[1].as_py()], "right": [right], "n": [len(y)]})

    votes = _tasks(spark, parts).mapInArrow(vote, "t long, least long, depth long, at long, y binary, votes binary")
    counted = votes.groupBy("least", "depth", "at").applyInArrow(count, "size long, least long, depth long, right long, n long")
    summed = counted.groupBy("size", "depth", "least").agg(F.sum("right"), F.sum("n")).collect()
    return {(r[0], depths[r[1]], leasts[r[2]]): (r[3], r[4]) for r in summed}


NODES = "tree int, columns binary"


def _nodes(t: Tree) -> pa.RecordBatch:
    import pickle

    columns = {k: np.asarray(v) for k, v in vars(t).items() if k not in ("number", "open")}
    return pa.RecordBatch.from_arrays([pa.array([t.number], pa.int32()), pa.array([pickle.dumps(columns)], pa.binary())], names=["tree", "columns"])


def _collected(rows: DataFrame) -> list[Tree]:
    import pickle

    found = sorted(rows.collect(), key=lambda r: r["tree"])
    return [Tree(r["tree"], open=[], **{k: v.tolist() for k, v in pickle.loads(r["columns"]).items()}) for r in found]


def fit_boosted(
    data: DataFrame,
    edges,
    classes: int,
    rounds: int,
    depth: int,
    step: float,
    rows_share: float = 1.0,
    features_share: float = 1.0,
    penalty: float = 1.0,
    least_weight: float = 1.0,
    seed: int = SEED,
) -> Ensemble:
    """Softmax boosting: every round grows a tree for each class from the gradients p - y and Hessians 2 p (1 - p)."""
    drawn = max(1, int(features_share * len(edges)))
    growth = Growth(depth, 1, len(edges), drawn, False, 1.0, least_weight, penalty, seed)
    model = Ensemble("boosted", classes, edges, [], step, penalty)

    def stats_of(rows: Rows, number: int, p: np.ndarray) -> np.ndarray:
        c = number % classes
        used = rows.w * (_fractions(rows.h.view(np.uint64), seed, number, 1) < rows_share)
        g, h = p[:, c] - (rows.y == c), np.maximum(2.0 * p[:, c] * (1.0 - p[:, c]), 1e-16)
        return np.column_stack([used * g, used * h, used > 0])

    if data.count() > 1:
        for begin in range(0, rounds, KEEP_MARGINS):
            recent: list[Tree] = []
            for r in range(begin, min(begin + KEEP_MARGINS, rounds)):
                fresh = [Tree(r * classes + c) for c in range(classes)]
                so_far = Ensemble("boosted", classes, edges, list(recent), step, penalty)

                def now(rows: Rows, number: int, so_far=so_far) -> np.ndarray:
                    if rows.p is None:  # once for all trees of the round
                        rows.p = softmax(rows.margins + so_far.margins(rows.x))
                    return stats_of(rows, number, rows.p)

                grow_all(data, growth, fresh, now)
                recent += fresh
            model.trees += recent
            if len(model.trees) < rounds * classes:
                data = _with_margins(data, Ensemble("boosted", classes, edges, recent, step, penalty))
        return model

    def boost(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = Rows.of(r)
                for n in range(rounds):
                    p = softmax(rows.margins)
                    fresh = [growth.grow(Tree(n * classes + c), rows.x, stats_of(rows, n * classes + c, p)) for c in range(classes)]
                    rows.margins += Ensemble("boosted", classes, edges, fresh, step, penalty).margins(rows.x)
                    for t in fresh:
                        yield _nodes(t)

    model.trees = _collected(data.mapInArrow(boost, NODES))
    return model


def _with_margins(data: DataFrame, recent: Ensemble) -> DataFrame:
    """The blocks with the margins of recent rounds added, written to the shared folder and read back."""

    def add(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = Rows.of(r)
                yield _block(r["rows"], r["x"], r["y"], r["w"], r["h"], (rows.margins + recent.margins(rows.x)).tobytes())

    path = scratch_path(data.sparkSession, "margins")
    data.mapInArrow(add, BLOCK).write.parquet(path)
    return data.sparkSession.read.parquet(path)


def hits(data: DataFrame, model: Ensemble, sizes: list[int], depths: list[int | None]) -> dict[tuple, tuple[int, int]]:
    """(right, all) rows for every prefix of the model: the first trees or rounds, cut at a depth."""

    def count(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = Rows.of(r)
                for i, depth in enumerate(depths):
                    total, at = np.zeros((len(rows.x), model.classes)), 0
                    for size in sorted(sizes):
                        part = Ensemble(model.kind, model.classes, model.edges, model.trees[at * model._per() : size * model._per()], model.step, model.penalty)
                        total += part.margins(rows.x) if model.kind == "boosted" else part.votes(rows.x, None, depth)
                        at = size
                        right = int((total.argmax(axis=1) == rows.y).sum())
                        yield pa.RecordBatch.from_pydict({"size": [size], "depth": [i], "right": [right], "n": [len(rows.x)]})

    found = data.mapInArrow(count, "size long, depth long, right long, n long").groupBy("size", "depth").agg(F.sum("right"), F.sum("n")).collect()
    return {(r[0], depths[r[1]]): (r[2], r[3]) for r in found}
