"""Cluster validity indices over ``x, y`` (or any coordinates) and a label column."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

TILE_ROWS = 2048


def block_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between two small blocks of rows, one coordinate at a time."""
    squares = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        squares += (a[:, i][:, None] - b[:, i][None, :]) ** 2
    return np.sqrt(squares)


def _moments(points: DataFrame, coords: list[str], label: str) -> DataFrame:
    return points.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in coords],
        *[F.var_pop(c).alias(f"v_{c}") for c in coords],
    )


def _within(coords: list[str]):
    return F.col("n") * sum((F.col(f"v_{c}") for c in coords[1:]), F.col(f"v_{coords[0]}"))


def inertia(points: DataFrame, coords: list[str], label: str = "cluster") -> DataFrame:
    """Sum of squared distances to the cluster means, from per-cluster variances."""
    return _moments(points, coords, label).agg(F.sum(_within(coords)).alias("inertia"))


def calinski_harabasz(points: DataFrame, coords: list[str], label: str = "cluster") -> DataFrame:
    """(B/(k−1)) / (W/(n−k)); 0 with a single label. One aggregation, no join.

    Total scatter equals within plus between, so neither needs the points again.
    """
    moments = _moments(points, coords, label)
    overall = moments.agg(*[(F.sum(F.col("n") * F.col(f"m_{c}")) / F.sum("n")).alias(c) for c in coords])
    gaps = moments.withColumns({f"g_{c}": F.col(f"m_{c}") - overall.select(c).scalar() for c in coords})
    squares = [F.col(f"g_{c}") * F.col(f"g_{c}") for c in coords]
    between = sum(squares[1:], squares[0])
    sums = gaps.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("total"),
        F.sum(_within(coords)).alias("w"),
        F.sum(F.col("n") * between).alias("b"),
    )
    k, total, w, b = (F.col(c) for c in ("k", "total", "w", "b"))
    score = F.when(w > 0, b * (total - k) / (w * (k - 1))).otherwise(F.lit(1.0))
    return sums.select(F.when(k > 1, score).otherwise(F.lit(0.0)).alias("calinski_harabasz"))


def _distance(a, b):
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a[1:], b[1:])), (a[0] - b[0]) * (a[0] - b[0])))


def davies_bouldin(points: DataFrame, coords: list[str], label: str = "cluster") -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; 0 with a single label.

    The spread joins each point to its cluster mean, an equi-join on the label whose
    small side has one row per cluster. Cluster pairs are compared inside one array.
    """
    centers = _moments(points, coords, label).select("label", *[f"m_{c}" for c in coords])
    spread = (
        points.select(F.col(label).alias("label"), *coords)
        .join(centers, "label")
        .groupBy("label", *[f"m_{c}" for c in coords])
        .agg(
            F.avg(
                _distance([F.col(c) for c in coords], [F.col(f"m_{c}") for c in coords])
            ).alias("s")
        )
    )
    packed = spread.agg(
        F.collect_list(F.struct("label", "s", *[f"m_{c}" for c in coords])).alias("all")
    )
    everyone = F.col("all")

    def worst(me):
        def similarity(other):
            gap = _distance([me[f"m_{c}"] for c in coords], [other[f"m_{c}"] for c in coords])
            both = me["s"] + other["s"]
            return F.when(gap > 0, both / gap).otherwise(F.when(both > 0, F.lit(math.inf)).otherwise(F.lit(0.0)))

        others = F.filter(everyone, lambda o: o["label"] != me["label"])
        return F.array_max(F.transform(others, similarity))

    scores = F.transform(everyone, worst)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + x)
    return packed.select(
        F.when(F.size(everyone) > 1, total / F.size(everyone)).otherwise(F.lit(0.0)).alias("davies_bouldin")
    )


def silhouette(
    points: DataFrame, coords: list[str], label: str = "cluster", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Exact mean Euclidean silhouette; 0 with a single label.

    Every point needs its distance to every other one, so the work is quadratic; use
    ``silhouette_squared`` for large tables. Equal points of a cluster are merged with
    their count first. The rest is cut into hash tiles of about ``tile_rows`` points;
    each pair of tiles is one bounded numpy block that returns distance sums per point
    and cluster, never the pairs.
    """
    merged = points.groupBy(*coords, F.col(label).cast("long").alias("label")).agg(
        F.count(F.lit(1)).alias("weight")
    )
    size = merged.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    tiles = max(1, math.ceil(size / tile_rows))
    tile = F.pmod(F.xxhash64(*coords, "label"), F.lit(tiles)).cast("int")
    packed = (
        merged.withColumn("tile", tile)
        .groupBy("tile")
        .agg(F.collect_list(F.struct(*coords, "label", "weight")).alias("rows"))
        .select("tile", *[F.col("rows")[c].alias(c) for c in (*coords, "label", "weight")])
    )
    columns = (*coords, "label", "weight")
    left = packed.select(
        F.col("tile").alias("left_tile"),
        *[F.col(c).alias(f"l_{c}") for c in columns],
        F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"),
    )
    # tiles are small and cost much, so their number, not their size, sets that of the tasks
    pairs = left.repartition(2 * tiles, "tile").join(packed.repartition(2 * tiles, "tile"), "tile")

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                a = np.column_stack([getattr(row, f"l_{c}") for c in coords])
                b = np.column_stack([getattr(row, c) for c in coords])
                gaps = block_distances(a, b)
                weights = np.asarray(row.weight)
                found, codes = np.unique(np.asarray(row.label), return_inverse=True)
                onehot = np.zeros((len(codes), len(found)))
                onehot[np.arange(len(codes)), codes] = weights
                total = gaps @ onehot
                n, k = total.shape
                block = {c: np.repeat(a[:, i], k) for i, c in enumerate(coords)}
                block["label"] = np.repeat(np.asarray(row.l_label), k)
                block["weight"] = np.repeat(np.asarray(row.l_weight), k)
                block["other"] = np.tile(found, n)
                block["distance"] = total.ravel()
                block["members"] = np.tile(onehot.sum(axis=0), n)
                yield pd.DataFrame(block)

    schema = ", ".join(
        [f"`{c}` double" for c in coords]
        + ["label long", "weight long", "other long", "distance double", "members double"]
    )
    per_cluster = (
        pairs.mapInPandas(sums, schema)
        .groupBy(*coords, "label", "weight", "other")
        .agg(F.sum("distance").alias("distance"), F.sum("members").alias("members"))
    )
    own = F.col("other") == F.col("label")
    per_point = per_cluster.groupBy(*coords, "label", "weight").agg(
        F.max(F.when(own, F.col("distance"))).alias("own_sum"),
        F.max(F.when(own, F.col("members"))).alias("own_size"),
        F.min(F.when(~own, F.col("distance") / F.col("members"))).alias("b"),
    )
    a = F.col("own_sum") / (F.col("own_size") - 1)
    b = F.col("b")
    value = F.when(
        (F.col("own_size") > 1) & b.isNotNull() & (F.greatest(a, b) > 0), (b - a) / F.greatest(a, b)
    ).otherwise(F.lit(0.0))
    return per_point.agg(
        F.coalesce(F.sum(value * F.col("weight")) / F.sum("weight"), F.lit(0.0)).alias("silhouette")
    )


def silhouette_squared(points: DataFrame, coords: list[str], label: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, linear in the number of points.

    The mean squared distance to a cluster is |p − m|² + spread, so one row per cluster
    is all a point needs; the rows travel as one array value.
    """
    moments = _moments(points, coords, label)
    spread = sum((F.col(f"v_{c}") for c in coords[1:]), F.col(f"v_{coords[0]}"))
    packed = moments.agg(
        F.collect_list(
            F.struct("label", "n", spread.alias("v"), *[f"m_{c}" for c in coords])
        ).alias("all")
    )
    df = points.select(F.col(label).alias("label"), *coords).withColumn("_all", packed.scalar())
    everyone = F.col("_all")

    def mean_gap(c):
        squares = [(F.col(x) - c[f"m_{x}"]) * (F.col(x) - c[f"m_{x}"]) for x in coords]
        return sum(squares[1:], squares[0]) + c["v"]

    own = F.filter(everyone, lambda c: c["label"] == F.col("label"))[0]
    others = F.filter(everyone, lambda c: c["label"] != F.col("label"))
    df = df.withColumns(
        {
            "_n": own["n"],
            "_a": mean_gap(own) * own["n"] / F.nullif(own["n"] - 1, F.lit(0)),
            "_b": F.array_min(F.transform(others, mean_gap)),
        }
    )
    a, b = F.col("_a"), F.col("_b")
    value = F.when(
        (F.col("_n") > 1) & b.isNotNull() & (F.greatest(a, b) > 0), (b - a) / F.greatest(a, b)
    ).otherwise(F.lit(0.0))
    return df.agg(F.coalesce(F.avg(value), F.lit(0.0)).alias("silhouette_squared"))


def all_indices(
    points: DataFrame, coords: list[str], label: str = "cluster", squared: bool = True
) -> DataFrame:
    """One row with silhouette, Calinski–Harabasz and Davies–Bouldin.

    The silhouette is the one with squared distances, linear in the points; ``squared=False``
    asks for the Euclidean one, which compares all pairs. A noise label counts as a cluster; a
    single label gives zeros.
    """
    first = (silhouette_squared if squared else silhouette)(points, coords, label)
    name = first.columns[0]
    return first.select(
        F.col(name).alias("silhouette_score"),
        calinski_harabasz(points, coords, label).scalar().alias("calinski_harabasz_index"),
        davies_bouldin(points, coords, label).scalar().alias("davies_bouldin_index"),
    )
