"""Density clustering of points in the plane as grid joins.

Cells have a diagonal just under ``eps``, so points sharing a cell are neighbours:
a cell with ``min_points`` points holds only core points and is never expanded into
pairs. Pairs are formed only for points of sparser cells (at most ``min_points`` − 1 per
cell) against the cells around them, which bounds them by a constant per point however
many points one cell holds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from plyscope.operators.density_any import NOISE, with_labels
from plyscope.operators.ranking import md5_row_number
from plyscope.session import cut_lineage

# Each refinement step cuts a box into 4 x 4. A power of two keeps the box indices of
# neighbouring levels exactly nested in floating point.
REFINE_BITS = 2
REACH = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]


def _side(eps: float) -> float:
    return eps / math.sqrt(2.0) * (1.0 - 1e-9)


def _cell(column: str, side: float):
    return F.floor(F.col(column) / F.lit(side))


def _squared(ax, ay, bx, by):
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return dx * dx + dy * dy


def _around(df: DataFrame, offsets=REACH) -> DataFrame:
    """One row per cell in reach; the reached cell becomes (ci, cj)."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets]))
    return (
        df.withColumn("_s", steps)
        .withColumns({"ci": F.col("ci") + F.col("_s.i"), "cj": F.col("cj") + F.col("_s.j")})
        .drop("_s")
    )


def gridded(points: DataFrame, eps: float, key: str, x: str, y: str) -> DataFrame:
    """Distinct locations with their cell, number of copies and smallest key."""
    side = _side(eps)
    return (
        points.groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_key"))
        .withColumns({"ci": _cell("x", side), "cj": _cell("y", side)})
    )


def core_locations(locations: DataFrame, eps: float, min_points: int) -> DataFrame:
    """Locations with a ``core`` flag: at least ``min_points`` points within ``eps``."""
    cells = locations.groupBy("ci", "cj").agg(F.sum("copies").alias("held"))
    marked = locations.join(cells, ["ci", "cj"])
    crowded = marked.where(F.col("held") >= min_points)
    sparse = marked.where(F.col("held") < min_points)
    asking = _around(sparse.select("ci", "cj", F.col("x").alias("qx"), F.col("y").alias("qy")))
    near = (
        asking.join(locations.select("ci", "cj", "x", "y", "copies"), ["ci", "cj"])
        .where(_squared("qx", "qy", "x", "y") <= eps * eps)
        .groupBy(F.col("qx").alias("x"), F.col("qy").alias("y"))
        .agg(F.sum("copies").alias("near"))
    )
    counted = sparse.join(near, ["x", "y"]).withColumn("core", F.col("near") >= min_points)
    columns = ["x", "y", "ci", "cj", "copies", "first_key"]
    return crowded.select(*columns, F.lit(True).alias("core")).unionByName(
        counted.select(*columns, "core")
    )


def _boxes(core: DataFrame, side: float, level: int) -> DataFrame:
    """Tight boxes of the core locations at a level, with one real location each."""
    step = side / 2 ** (REFINE_BITS * level)
    return core.groupBy("ci", "cj", _cell("x", step).alias("bx"), _cell("y", step).alias("by")).agg(
        F.min("x").alias("x0"),
        F.max("x").alias("x1"),
        F.min("y").alias("y0"),
        F.max("y").alias("y1"),
        F.min(F.struct("x", "y")).alias("p"),
    )


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def linked_cells(core: DataFrame, eps: float) -> DataFrame:
    """Pairs of cells with core locations within ``eps`` of each other.

    Whole cells are compared first, as tight boxes. A pair is settled when two real
    locations are close enough, or when the boxes are too far apart; what is left is cut
    into smaller boxes and compared again. A box with one location settles every pair,
    so the loop ends; only boxes whose gap is about ``eps`` go more than a step or two.
    """
    side = _side(eps)
    forward = [o for o in REACH if o > (0, 0)]
    a, b = ("a_ci", "a_cj"), ("b_ci", "b_cj")
    level, linked = 0, None
    boxes = _boxes(core, side, 0)
    open_pairs = (
        _around(boxes.select("ci", "cj", F.col("ci").alias("a_ci"), F.col("cj").alias("a_cj")), forward)
        .withColumnsRenamed({"ci": "b_ci", "cj": "b_cj"})
    )
    left_keys, right_keys = ["a_ci", "a_cj"], ["b_ci", "b_cj"]
    while True:
        compared = open_pairs.join(_renamed(boxes, "a_"), left_keys).join(_renamed(boxes, "b_"), right_keys)

        def gap(low, high):
            return F.greatest(
                F.lit(0.0), F.col(f"b_{low}") - F.col(f"a_{high}"), F.col(f"a_{low}") - F.col(f"b_{high}")
            )

        gx, gy = gap("x0", "x1"), gap("y0", "y1")
        tested = compared.withColumns(
            {
                "met": _squared("a_p.x", "a_p.y", "b_p.x", "b_p.y") <= eps * eps,
                "apart": gx * gx + gy * gy > eps * eps,
                "point": (F.col("a_x0") == F.col("a_x1"))
                & (F.col("a_y0") == F.col("a_y1"))
                & (F.col("b_x0") == F.col("b_x1"))
                & (F.col("b_y0") == F.col("b_y1")),
            }
        )
        tested = cut_lineage(tested.select(*a, *b, "a_bx", "a_by", "b_bx", "b_by", "met", "apart", "point"))
        met = tested.where("met").select(*a, *b).distinct()
        linked = met if linked is None else linked.unionByName(met)
        rest = tested.where("not met and not apart and not point").join(met, [*a, *b], "left_anti")
        if rest.isEmpty():
            return cut_lineage(linked.distinct())
        cells = rest.select(F.col("a_ci").alias("ci"), F.col("a_cj").alias("cj")).union(
            rest.select("b_ci", "b_cj")
        ).distinct()
        level += 1
        finer = _boxes(core.join(cells, ["ci", "cj"], "left_semi"), side, level)
        parent = {"pbx": F.shiftright("bx", REFINE_BITS), "pby": F.shiftright("by", REFINE_BITS)}
        boxes = finer.withColumns(parent)
        open_pairs = rest.select(
            *a, *b,
            F.col("a_bx").alias("a_pbx"), F.col("a_by").alias("a_pby"),
            F.col("b_bx").alias("b_pbx"), F.col("b_by").alias("b_pby"),
        )
        left_keys = ["a_ci", "a_cj", "a_pbx", "a_pby"]
        right_keys = ["b_ci", "b_cj", "b_pbx", "b_pby"]


def connected_cells(cells: DataFrame, links: DataFrame) -> DataFrame:
    """Component of every cell: smallest label over linked cells, with pointer jumping.

    A cell has at most 24 links. Each round takes the smallest label around a cell and
    then the label of that label, so long chains shrink quickly; a reliable checkpoint
    ends each round.
    """
    ids = cells.select(F.struct("ci", "cj").alias("node"))
    ends = links.select(F.struct("a_ci", "a_cj").alias("s"), F.struct("b_ci", "b_cj").alias("t"))
    node = "struct<ci:bigint,cj:bigint>"
    edges = ends.select(F.col("s").cast(node), F.col("t").cast(node)).union(
        ends.select(F.col("t").cast(node), F.col("s").cast(node))
    )
    edges = cut_lineage(edges)
    labels = ids.select(F.col("node").cast(node), F.col("node").cast(node).alias("label"))
    while True:
        seen = (
            edges.join(labels.withColumnsRenamed({"node": "t", "label": "seen"}), "t")
            .groupBy("s")
            .agg(F.min("seen").alias("seen"))
        )
        lowered = labels.join(seen.withColumnRenamed("s", "node"), "node", "left").select(
            "node", "label", F.least("label", F.coalesce("seen", "label")).alias("low")
        )
        jump = lowered.select(F.col("node").alias("low"), F.col("low").alias("jumped"))
        jumped = cut_lineage(
            lowered.join(jump, "low", "left").select(
                "node", "label", F.least("low", F.coalesce("jumped", "low")).alias("new")
            )
        )
        changed = not jumped.where(F.col("new") != F.col("label")).isEmpty()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not changed:
            return labels.select("node.ci", "node.cj", F.col("label").alias("component"))


def density_clusters(
    points: DataFrame,
    eps: float = 0.5,
    min_points: int = 5,
    key: str = "player",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Points with ``cluster`` (−1 for noise) and ``core``.

    Clusters are numbered from 0 in md5 order of their smallest core key. A border point
    takes the smallest number among the clusters that reach it.
    """
    locations = core_locations(gridded(points, eps, key, x, y), eps, min_points)
    locations = cut_lineage(locations)
    core = locations.where("core")
    cells = core.select("ci", "cj").distinct()
    components = connected_cells(cells, linked_cells(core, eps))
    labelled = core.join(components, ["ci", "cj"])
    firsts = labelled.groupBy("component").agg(F.min("first_key").alias("first_key"))
    numbered = md5_row_number(firsts.withColumn("_one", F.lit(1)), ["_one"], [F.col("first_key")], "number")
    numbered = numbered.select("component", (F.col("number") - 1).alias("cluster"))
    core_labels = cut_lineage(
        labelled.join(numbered, "component").select("x", "y", "ci", "cj", "cluster")
    )
    asking = _around(
        locations.where("not core").select("ci", "cj", F.col("x").alias("qx"), F.col("y").alias("qy"))
    )
    border = (
        asking.join(core_labels, ["ci", "cj"])
        .where(_squared("qx", "qy", "x", "y") <= eps * eps)
        .groupBy(F.col("qx").alias("x"), F.col("qy").alias("y"))
        .agg(F.min("cluster").alias("cluster"))
    )
    found = core_labels.select("x", "y", "cluster", F.lit(True).alias("core")).unionByName(
        border.select("x", "y", "cluster", F.lit(False).alias("core"))
    )
    found = found.join(locations.select("x", "y", "copies"), ["x", "y"]).withColumnsRenamed({"x": "_x", "y": "_y"})
    keyed = points.drop("cluster", "core").withColumns(
        {"_x": F.col(x).cast("double"), "_y": F.col(y).cast("double")}
    )
    return with_labels(keyed, cut_lineage(found), ["_x", "_y"]).drop("_x", "_y")


def core_flags(
    points: DataFrame, eps: float, min_points: int, key: str = "player", x: str = "x", y: str = "y"
) -> DataFrame:
    """Points with their core flag only."""
    flags = core_locations(gridded(points, eps, key, x, y), eps, min_points).select(
        F.col("x").alias("_x"), F.col("y").alias("_y"), "core"
    )
    keyed = points.withColumns({"_x": F.col(x).cast("double"), "_y": F.col(y).cast("double")})
    return keyed.join(flags, ["_x", "_y"]).drop("_x", "_y")
