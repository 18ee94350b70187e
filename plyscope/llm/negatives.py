"""Hard negatives: rows of another label whose score lies in a window below that of each of an anchor's positives.

Each component x becomes the integer floor(256 x); a score is the integer inner product with the anchor. An anchor's
positives are its best other rows of the same label. A positive of score p asks for the best rows of other labels with
``low * p <= 100 * score <= high * p``. Higher scores come first, ties go to the smaller id.

The anchors, which the caller states, are put into blocks, near ones together, and a minimum spanning tree is laid
through the anchors of a block. Where anchor and candidate blocks meet, only the root scores every candidate. A child c of
parent p has ``score(c, x) = score(p, x) + (c - p) . x``, which lies within ``|c - p| |x|`` of the parent's score, so the
parent's bounds, widened by the edge, bound the child's; only candidates whose bounds overlap what the child looks for
are scored again, and exact scores replace their bounds on the way down. Positives are looked for among the rows of the
same label, above the worst of the best so far; negatives among the others, inside the windows of the known positives.

Every block of anchors is copied once for each share of the rows, so a task holds one block of each at a time whatever
the size of the table, and no step is keyed by a label or a vector that may be common.

Rows take no part without an id, with a NULL label, a NULL vector, or a NULL or non-finite component. Only vectors of
equal dimension meet. Rows equal in id, label and vector count once; of rows that share an id but differ, each is a row
of its own, but none is another one's positive or negative. Columns besides the three are left out. Scores must fit into
a long; they are exact then.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plyscope.llm.common import settled, tasks_for

SCALE = 256
EXACT = 2.0**53
LOW, HIGH = 30, 90
POSITIVES, NEGATIVES = 5, 10
ANCHOR_ROWS = 512
BLOCK_ROWS = 4096
AXES = 12

BLOCK = "dims int, part int, ids binary, labels binary, data binary"
ANCHORS = f"{BLOCK}, parents binary, edges binary"


def labelled_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, v) of the rows that take part, v holding whole numbers."""
    named = df.select(
        F.col(f"`{key}`").alias("k"), F.struct(F.col(f"`{vector}`").alias("v"), F.col(f"`{label}`").cast("long").alias("label")).alias("s")
    )
    flat = named.where("k is not null and s.label is not null").select(F.col("k"), F.col("s.v").alias("v"), F.col("s.label").alias("label"))
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return flat.where(v.isNotNull() & finite).select(F.col("k").cast("long").alias("id"), "label", whole.alias("v")).distinct()


def spanning_tree(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows of ``m``: an order with parents first, the parent's place in it (-1: root), edges."""
    n = len(m)
    squares = np.einsum("ij,ij->i", m, m)
    order, parents, edges = [0], [-1], [0.0]
    place = np.zeros(n, dtype=np.int64)
    nearest = np.full(n, np.inf)
    via = np.zeros(n, dtype=np.int64)
    left = np.ones(n, dtype=bool)
    left[0] = False
    last = 0
    for _ in range(n - 1):
        gaps = np.maximum(squares + squares[last] - 2.0 * (m @ m[last]), 0.0)
        closer = left & (gaps < nearest)
        nearest[closer], via[closer] = gaps[closer], last
        last = int(np.argmin(np.where(left, nearest, np.inf)))
        left[last] = False
        place[last] = len(order)
        order.append(last)
        parents.append(int(place[via[last]]))
        edges.append(float(np.linalg.norm(m[last] - m[via[last]])))
    return np.array(order), np.array(parents, dtype=np.int64), np.array(edges)


def packed(rows: DataFrame, size: int, trees: bool = False) -> DataFrame:
    """Rows (id, label, v) of each partition in blocks of one dimension, ``part`` numbering those of a partition."""

    def pack(batches):
        held: dict[int, list] = {}
        part = 0
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            lists = batch.column(2)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            for d in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == d)
                held.setdefault(d, []).append((ids[at], labels[at], values[(ends[at] - d)[:, None] + np.arange(d)]))
                while sum(len(x[0]) for x in held[d]) >= size:
                    i, c, m = (np.concatenate(x) for x in zip(*held[d], strict=True))
                    held[d] = [(i[size:], c[size:], m[size:])]
                    yield block(d, part, i[:size], c[:size], m[:size])
                    part += 1
        for d, parts in held.items():
            i, c, m = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(i):
                yield block(d, part, i, c, m)
                part += 1

    def block(d, part, i, c, m):
        extra = []
        if trees:
            order, parents, edges = spanning_tree(m)
            i, c, m = i[order], c[order], m[order]
            extra = [pa.array([parents.astype("<i8").tobytes()], pa.binary()), pa.array([edges.astype("<f8").tobytes()], pa.binary())]
        data = [i.astype("<i8"), c.astype("<i8"), np.ascontiguousarray(m, "<f8")]
        cells = [pa.array([d], pa.int32()), pa.array([part], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in data], *extra]
        return pa.RecordBatch.from_arrays(cells, names=[x.split()[0] for x in (ANCHORS if trees else BLOCK).split(", ")])

    return rows.select("id", "label", "v").mapInArrow(pack, ANCHORS if trees else BLOCK)


def _near_together() -> F.Column:
    """Signs of a few pseudo-random projections: anchors that share them tend to be near."""

    def sign(axis: int) -> F.Column:
        signed = F.transform("v", lambda x, i: F.when(F.xxhash64(F.lit(axis), i) % 2 == 0, x).otherwise(-x))
        total = F.aggregate(signed, F.lit(0.0), lambda a, x: a + x)
        return F.when(total < 0, F.lit("0")).otherwise(F.lit("1"))

    return F.concat(*[sign(axis) for axis in range(AXES)])


class Pair:
    """A block of anchors and one of candidates: scores on demand, bounds down the tree."""

    def __init__(self, anchors: dict, rows: dict):
        d = anchors["dims"]
        self.ids, self.labels = (np.frombuffer(anchors[c], "<i8") for c in ("ids", "labels"))
        self.a = np.frombuffer(anchors["data"], "<f8").reshape(len(self.ids), d)
        self.parents, self.edges = np.frombuffer(anchors["parents"], "<i8"), np.frombuffer(anchors["edges"], "<f8")
        self.row_ids, self.row_labels = (np.frombuffer(rows[c], "<i8") for c in ("ids", "labels"))
        self.x = np.frombuffer(rows["data"], "<f8").reshape(len(self.row_ids), d)
        self.lengths = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        most = [float(np.abs(m).max(initial=0.0)) for m in (self.a, self.x)]
        self.exact = most[0] * most[1] * max(d, 1) < EXACT
        self.slack = 1e-9 * (1.0 + most[0] * np.sqrt(d) * self.lengths)
        if not self.exact:
            self.ai, self.xi = self.a.astype(np.int64), self.x.astype(np.int64)
        self.scored = 0

    def scores(self, j: int, at: np.ndarray) -> np.ndarray:
        self.scored += len(at)
        if self.exact:
            return self.x[at] @ self.a[j]
        return self.xi[at] @ self.ai[j]

    def down(self, wanted):
        """For every anchor: its place, candidates and scores. ``wanted(j, lo, hi)`` tells, from bounds on the scores of
        all candidates, which to score."""
        children = np.bincount(self.parents[1:], minlength=len(self.ids))
        bounds: dict[int, tuple] = {}
        for j, parent in enumerate(self.parents):
            if parent < 0:
                at = np.arange(len(self.x))
                exact = self.scores(j, at)
                lo, hi = exact - self.slack, exact + self.slack
                keep = wanted(j, lo, hi)
                yield j, at[keep], exact[keep]
            else:
                room = self.edges[j] * self.lengths + self.slack
                lo, hi = bounds[parent][0] - room, bounds[parent][1] + room
                at = np.flatnonzero(wanted(j, lo, hi))
                exact = self.scores(j, at)
                yield j, at, exact
                if children[j]:
                    lo[at], hi[at] = exact - self.slack[at], exact + self.slack[at]
                children[parent] -= 1
                if not children[parent]:
                    del bounds[parent]
            if children[j]:
                bounds[j] = lo, hi

    def positives(self, k: int):
        """place, candidate, score of the k best rows of the same label."""
        for j, at, exact in self.down(self._best_of_label(k)):
            order = np.lexsort((self.row_ids[at], -exact))[:k]
            yield j, at[order], exact[order]

    def _best_of_label(self, k: int):
        def wanted(j, lo, hi):
            own = (self.row_labels == self.labels[j]) & (self.row_ids != self.ids[j])
            floors = lo[own]
            if len(floors) > k:  # the k-th best is at least the k-th best lower bound
                own &= hi >= np.partition(floors, len(floors) - k)[len(floors) - k]
            return own

        return wanted

    def negatives(self, k: int, positives: dict[int, list[tuple[int, int]]], low: int, high: int):
        """place, positive, candidate, score of the k best rows of other labels in every positive's window."""

        def wanted(j, lo, hi):
            inside = np.zeros(len(lo), dtype=bool)
            for _, p in positives.get(j, ()):
                inside |= (100 * hi >= low * p) & (100 * lo <= high * p)
            return inside & (self.row_labels != self.labels[j]) & (self.row_ids != self.ids[j])

        for j, at, exact in self.down(wanted):
            whole = exact.astype(np.int64)
            order = np.lexsort((self.row_ids[at], -whole))
            at, whole = at[order], whole[order]
            for positive, p in positives.get(j, ()):
                # 100 s between low p and high p, in whole numbers
                first, last = -(-low * p // 100), high * p // 100
                begin, end = (int(np.searchsorted(-whole, -edge, side)) for edge, side in ((last, "left"), (first, "right")))
                got = slice(begin, min(end, begin + k))
                if begin < end:
                    yield j, positive, p, at[got], whole[got]


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    anchor_rows: int = ANCHOR_ROWS,
    block_rows: int = BLOCK_ROWS,
    shares: int | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for vectors (id, label, v) of whole numbers.

    Anchors are the rows whose id is divisible by ``every``. An anchor row that shares its id with another one is mined
    on its own, so its id then heads the rows of both.
    """
    vectors = settled(vectors)
    shares = shares or tasks_for(vectors.count(), 4 * block_rows)
    stated = vectors.where(F.pmod("id", F.lit(every)) == 0)
    near = stated.withColumn("_near", _near_together()).repartitionByRange(tasks_for(stated.count(), 4 * anchor_rows), "_near", "id")
    anchors = settled(packed(near.sortWithinPartitions("_near", "id"), anchor_rows, trees=True).withColumn("block", F.monotonically_increasing_id()))
    held = settled(packed(vectors.repartition(shares), block_rows).withColumn("share", F.spark_partition_id() % shares))
    rows = held.select("share", F.struct("dims", "ids", "labels", "data").alias("x"))
    copies = anchors.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    asked = copies.select("share", "block", F.struct("dims", "ids", "labels", "data", "parents", "edges").alias("a"))

    def find_positives(batches):
        for batch in batches:
            for r in batch.to_pylist():
                if r["a"]["dims"] == r["x"]["dims"]:
                    pair = Pair(r["a"], r["x"])
                    for j, at, score in pair.positives(positives):
                        yield _found(r["block"], j, pair.row_ids[at], score.astype(np.int64))

    pairs = asked.join(rows, "share").select("block", "a", "x")
    found = pairs.mapInArrow(find_positives, "block long, place int, row_id long, score long")
    best = _first(found, ["block", "place"], positives)
    # what a block of anchors looks for: at most anchor_rows x positives entries
    wanted = settled(best.groupBy("block").agg(F.collect_list(F.struct("place", "row_id", "score")).alias("wanted")))
    told = anchors.join(wanted, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    told = told.select("share", "block", "wanted", F.struct("dims", "ids", "labels", "data", "parents", "edges").alias("a"))

    def find_negatives(batches):
        for batch in batches:
            for r in batch.to_pylist():
                if r["a"]["dims"] != r["x"]["dims"]:
                    continue
                sought: dict[int, list[tuple[int, int]]] = {}
                for w in r["wanted"]:
                    sought.setdefault(w["place"], []).append((w["row_id"], w["score"]))
                pair = Pair(r["a"], r["x"])
                out = list(pair.negatives(negatives, sought, low, high))
                if out:
                    counts = [len(x[3]) for x in out]
                    cells = [np.repeat([x[i] for x in out], counts) for i in (0, 1, 2)]
                    at = np.concatenate([x[3] for x in out])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), r["block"])),
                            pa.array(cells[0].astype(np.int32)),
                            pa.array(pair.ids[cells[0]]),
                            pa.array(cells[1]),
                            pa.array(cells[2]),
                            pa.array(pair.row_ids[at]),
                            pa.array(np.concatenate([x[4] for x in out])),
                        ],
                        names=["block", "place", "anchor_id", "positive_id", "positive_score", "row_id", "score"],
                    )

    mined = told.join(rows, "share").select("block", "wanted", "a", "x").mapInArrow(
        find_negatives,
        "block long, place int, anchor_id long, positive_id long, positive_score long, row_id long, score long",
    )
    ranked = _first(mined, ["block", "place", "positive_id", "positive_score"], negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _found(block: int, place: int, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    cells = [np.full(n, block), np.full(n, place, dtype=np.int32), ids, scores]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["block", "place", "row_id", "score"])


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of every key, ranked from 1."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
