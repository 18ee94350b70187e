"""Density clustering in any number of coordinates: pivot cells with a halo, local clusters, merged by shared core points.

Copies of a location count once, with their number. Each location is at home in the cell of its nearest pivot and a guest
in every cell whose pivot is at most two radii farther: whoever is at home there and within the radius has it at hand.
The members of a cell are dealt to parts of bounded size, and each part of those at home meets each part of all members
as one block of distances. The first pass adds up, for every location, the points within the radius; the second joins,
within a block, the core locations that touch, as few links as make their groups, and names for each border location the
groups that reach it. Groups that share a core location are one cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plyscope.operators.indices import block_distances
from plyscope.operators.ranking import md5_row_number
from plyscope.session import cut_lineage

NOISE = -1
PART_ROWS = 2048
#: Copies from which a location's points are labelled apart from the join on locations.
HOT = 1 << 16


def _members(locations: DataFrame, d: int, eps: float, part_rows: int) -> DataFrame:
    """(cell, loc, v, copies, home): every location in each cell that may ask for it."""
    n = locations.count()
    wanted = min(math.ceil(n / part_rows), 4 * math.isqrt(max(n, 1))) if n > part_rows else 1
    some = F.pmod(F.xxhash64(F.lit("pivot"), "v"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 3.0 * wanted / max(n, 1)))
    # their number is of the order of the root of the locations
    pivots = np.array(sorted(r[0] for r in locations.where(some).select("v").collect())) if wanted > 1 else np.zeros((0, d))
    if len(pivots) < 2:
        pivots = np.zeros((1, d))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame["v"].tolist(), dtype=float).reshape(len(frame), d)
            for begin in range(0, len(x), 1024):
                gaps = block_distances(x[begin : begin + 1024], pivots)
                nearest = gaps.argmin(axis=1)
                row, cell = np.nonzero(gaps <= gaps.min(axis=1, keepdims=True) + 2 * eps * (1 + 1e-9) + 1e-12)
                yield frame.iloc[begin + row].assign(cell=cell.astype(np.int64), home=nearest[row] == cell)

    return locations.select("loc", "v", "copies").mapInPandas(place, "loc long, v array<double>, copies long, cell long, home boolean")


def _parts(members: DataFrame, part_rows: int, prefix: str) -> DataFrame:
    """Members of a cell in parts of about ``part_rows``."""
    sizes = members.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"))
    part = F.pmod(F.xxhash64("loc"), F.ceil(F.col("_n") / part_rows))
    listed = members.join(sizes, "cell").withColumn("part", part).groupBy("cell", "part")
    rows = listed.agg(F.collect_list(F.struct("loc", "v", "copies", "core")).alias("r"))
    return rows.select("cell", *[F.col(f"r.{c}").alias(f"{prefix}{c}") for c in ("loc", "copies", "core")], F.flatten("r.v").alias(f"{prefix}v"))


def _blocks(members: DataFrame, part_rows: int, tasks: int) -> DataFrame:
    """Pairs of parts of a cell; cells cost much and are small, so their number sets that of the tasks."""
    a, b = _parts(members.where("home"), part_rows, "a_"), _parts(members, part_rows, "b_")
    return a.repartition(tasks, "cell").join(b.repartition(tasks, "cell"), "cell").drop("cell")


def _within(row, d: int, eps: float) -> np.ndarray:
    a, b = (np.asarray(v, dtype=float).reshape(-1, d) for v in (row.a_v, row.b_v))
    squares = np.zeros((len(a), len(b)))
    for j in range(d):
        squares += (a[:, j][:, None] - b[:, j][None, :]) ** 2
    return squares <= eps * eps


def _groups(touch: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of the connected group of every row and column that touches something; its own id otherwise."""
    top = max(a.max(initial=0), b.max(initial=0)) + 1
    rows, columns = a.copy(), b.copy()
    while True:
        new_rows = np.minimum(rows, np.where(touch, columns[None, :], top).min(axis=1, initial=top))
        new_columns = np.minimum(columns, np.where(touch, new_rows[:, None], top).min(axis=0, initial=top))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for linked (s, t): smallest label around a node, then the label of that label, round by round."""
    edges = cut_lineage(links.union(links.select("t", "s")).distinct())
    labels = edges.groupBy(F.col("s").alias("node")).agg(F.min(F.least("s", "t")).alias("root"))
    while True:
        around = edges.join(labels.select(F.col("node").alias("t"), "root"), "t").groupBy(F.col("s").alias("node")).agg(F.min("root").alias("seen"))
        low = cut_lineage(labels.join(around, "node").select("node", "root", F.least("root", "seen").alias("low")))
        jump = low.select(F.col("node").alias("low"), F.col("low").alias("over"))
        new = cut_lineage(low.join(jump, "low", "left").select("node", "root", F.least("low", F.coalesce("over", "low")).alias("new")))
        labels = new.select("node", F.col("new").alias("root"))
        if new.where("new < root").isEmpty():
            return labels


def density_clusters_any(
    points: DataFrame, coords: list[str], eps: float = 0.5, min_points: int = 5, key: str = "player", part_rows: int = PART_ROWS
) -> DataFrame:
    """Points with ``cluster`` (−1 for noise) and ``core``, by the rules of the form for the plane.

    Clusters are numbered from 0 in md5 order of their smallest core key. A border point takes the smallest number
    among the clusters that reach it. Points with a NULL or NaN coordinate are noise.
    """
    d = len(coords)
    v = F.array(*[F.col(c).cast("double") for c in coords])
    known = points.select(v.alias("v"), F.col(key).alias("k")).where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))
    # -0.0 and 0.0 are one place
    known = known.withColumn("v", F.transform("v", lambda x: x + 0.0))
    grouped = known.groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("k").alias("first_key"))
    locations = cut_lineage(grouped.withColumn("loc", F.monotonically_increasing_id()))
    members = cut_lineage(_members(locations, d, eps, part_rows))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                near = _within(row, d, eps) @ np.asarray(row.b_copies, dtype=np.int64)
                yield pd.DataFrame({"loc": np.asarray(row.a_loc), "near": near})

    plain = members.withColumn("core", F.lit(False))
    tasks = (members.agg(F.max("cell")).first()[0] or 0) + 1
    counts = _blocks(plain, part_rows, tasks).mapInPandas(count, "loc long, near long").groupBy("loc").agg(F.sum("near").alias("near"))
    flags = cut_lineage(counts.select("loc", (F.col("near") >= min_points).alias("core")))

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                a, b = np.asarray(row.a_loc, dtype=np.int64), np.asarray(row.b_loc, dtype=np.int64)
                a_core, b_core = np.asarray(row.a_core, dtype=bool), np.asarray(row.b_core, dtype=bool)
                touch = _within(row, d, eps) & b_core[None, :]
                inner = touch & a_core[:, None]
                rows, columns = _groups(inner, a, b)
                i, j = np.flatnonzero(rows != a), np.flatnonzero(columns != b)
                yield pd.DataFrame({"s": np.concatenate([a[i], b[j]]), "t": np.concatenate([rows[i], columns[j]]), "border": False})
                edge, near = np.nonzero(touch & ~a_core[:, None])
                reached = pd.DataFrame({"s": a[edge], "t": columns[near], "border": True}).drop_duplicates()
                yield reached

    found = _blocks(members.join(flags, "loc"), part_rows, tasks).mapInPandas(link, "s long, t long, border boolean")
    found = cut_lineage(found.distinct())
    core = locations.join(flags.where("core"), "loc")
    roots = connected(found.where("not border").select("s", "t"))
    rooted = core.join(roots.withColumnRenamed("node", "loc"), "loc", "left").withColumn("root", F.coalesce("root", "loc"))
    rooted = cut_lineage(rooted.select("loc", "root", "first_key"))
    firsts = rooted.groupBy("root").agg(F.min("first_key").alias("first_key"))
    numbered = md5_row_number(firsts.withColumn("_one", F.lit(1)), ["_one"], [F.col("first_key")], "number")
    numbered = numbered.select("root", (F.col("number") - 1).alias("cluster"))
    cores = rooted.join(numbered, "root").select("loc", "cluster")
    reached = found.where("border").select(F.col("s").alias("loc"), F.col("t").alias("near"))
    border = reached.join(cores.withColumnRenamed("loc", "near"), "near").groupBy("loc").agg(F.min("cluster").alias("cluster"))
    labels = cores.withColumn("core", F.lit(True)).unionByName(border.withColumn("core", F.lit(False)))
    labelled = cut_lineage(locations.select("loc", "v", "copies").join(labels, "loc").select(F.col("v").alias("_v"), "copies", "cluster", "core"))
    keyed = points.drop("cluster", "core").withColumn("_v", F.transform(v, lambda x: x + 0.0))
    return with_labels(keyed, labelled, ["_v"]).drop("_v")


def with_labels(points: DataFrame, labelled: DataFrame, on: list[str], hot: int = HOT) -> DataFrame:
    """Points with the cluster and core flag of their location (``on``, copies, cluster, core); noise without one.

    The points of a location with many copies do not meet in one task: such locations, at most one for every ``hot``
    points, go to the points instead.
    """
    few = F.broadcast(labelled.where(F.col("copies") > hot).drop("copies"))
    many = labelled.where(F.col("copies") <= hot).drop("copies")
    crowded = points.join(few, on)
    rest = points.join(few.select(*on), on, "left_anti").join(many, on, "left")
    filled = {"cluster": F.coalesce("cluster", F.lit(NOISE)).cast("int"), "core": F.coalesce("core", F.lit(False))}
    return crowded.unionByName(rest).withColumns(filled)
