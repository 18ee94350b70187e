from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyscope.operators import clusters, microclusters, multistart

XY = ["x", "y"]


def cloud(spark, n, scale=1.0, seed=3):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, 2)) + rng.integers(0, 4, n)[:, None] * 8) * scale
    return x, spark.createDataFrame([(f"p{i}", *map(float, v)) for i, v in enumerate(x)], "player string, x double, y double")


def brute_ward(x):
    """One merge at a time by the growth of the sum of squares."""
    groups, heights = [[i] for i in range(len(x))], []
    means, sizes = list(x), [1] * len(x)
    while len(groups) > 1:
        m, s = np.array(means), np.array(sizes, dtype=float)
        gaps = ((m[:, None] - m[None]) ** 2).sum(axis=2) * 2 * s[:, None] * s[None] / (s[:, None] + s[None])
        gaps[np.tril_indices(len(m))] = np.inf
        i, j = np.unravel_index(gaps.argmin(), gaps.shape)
        heights.append(np.sqrt(gaps[i, j]))
        means[i] = (means[i] * sizes[i] + means[j] * sizes[j]) / (sizes[i] + sizes[j])
        sizes[i] += sizes[j]
        groups[i] += groups[j]
        for held in (groups, means, sizes):
            del held[j]
        if len(groups) == 4:
            four = {frozenset(g) for g in groups}
    return heights, four


def test_ward_heights_and_cut_equal_brute_force(spark):
    x, df = cloud(spark, 300)
    heights, four = brute_ward(x)
    merges = microclusters.ward(x, np.ones(300))
    assert [h for _, _, h in merges] == pytest.approx(heights)
    got: dict = {}
    for r in clusters.cluster(df, "hierarchical", 4).labelled.collect():
        got.setdefault(r["cluster"], set()).add(int(r["player"][1:]))
    assert {frozenset(g) for g in got.values()} == four and sorted(got) == [0, 1, 2, 3]


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e7])
def test_number_of_features_is_bounded_on_any_scale(spark, scale, monkeypatch):
    monkeypatch.setattr(multistart, "BLOCK_ROWS", 500)
    x, df = cloud(spark, 2000, scale)
    cells = microclusters.adaptive_cells(df, XY, 64)
    found = microclusters.features(cells, spark, XY)
    rows = found.collect()
    assert 32 < len(rows) <= 64 and sum(r["n"] for r in rows) == 2000
    total = found.agg(F.sum("sum_x"), F.sum("sum_y"), F.sum("sum_squares")).first()
    assert tuple(total) == pytest.approx((x[:, 0].sum(), x[:, 1].sum(), (x**2).sum()))
    placed = {r["cell"]: r["n"] for r in df.groupBy(cells.column(XY).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert placed == {r["cell"]: r["n"] for r in rows}
    labels = {r["player"]: r["cluster"] for r in clusters.cluster(df, "birch", 4, restarts=3, most_cells=64, cell_width=0.0).labelled.collect()}
    exact = {r["player"]: r["cluster"] for r in clusters.cluster(df, "kmeans", 4, restarts=3).labelled.collect()}
    pairs = {(labels[p], exact[p]) for p in labels}
    assert len(pairs) <= 8 and len(set(labels.values())) == 4


def test_radius_stops_the_cells(spark):
    _, df = cloud(spark, 500)
    cells = microclusters.adaptive_cells(df, XY, 400, radius=3.0)
    assert 4 <= len(cells.leaves()) < 40
    assert all(cells.spread(i).sum() <= 9.0 for i in cells.leaves())


def test_copies_unknown_values_and_nothing(spark):
    rows = [("a", 1.0, 1.0)] * 50 + [("b", 2.0, 1.0), ("c", None, 1.0), ("d", float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "player string, x double, y double")
    cells = microclusters.adaptive_cells(df, XY)
    assert sorted(r["n"] for r in microclusters.features(cells, spark, XY).collect()) == [1, 50]
    got = {r["player"]: r["cluster"] for r in clusters.cluster(df, "hierarchical", 2).labelled.collect()}
    assert got["a"] != got["b"] and got["c"] is None and got["d"] is None
    assert clusters.cluster(df.limit(0), "hierarchical", 2).labelled.collect() == []
    assert microclusters.features(microclusters.adaptive_cells(df.limit(0), XY), spark, XY).collect() == []
