"""Density clusters, indices and profiles against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyscope.operators import clusters, indices, profiles, scaling
from plyscope.operators.density import density_clusters

SCHEMA = "id long, x double, y double"


def brute_density(points, eps, min_points):
    """Core flags and clusters as sets of core ids; border and noise separately."""
    xy = np.array([(x, y) for _, x, y in points])
    near = ((xy[:, None, 0] - xy[None, :, 0]) ** 2 + (xy[:, None, 1] - xy[None, :, 1]) ** 2) <= eps * eps
    core = near.sum(axis=1) >= min_points
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in np.flatnonzero(core):
        for j in np.flatnonzero(near[i] & core):
            parent[find(i)] = find(j)
    groups = {}
    for i in np.flatnonzero(core):
        groups.setdefault(find(i), set()).add(points[i][0])
    border = {
        points[i][0]: {find(j) for j in np.flatnonzero(near[i] & core)} for i in np.flatnonzero(~core)
    }
    return core, groups, border


def check_density(spark, points, eps, min_points):
    got = density_clusters(spark.createDataFrame(points, SCHEMA), eps, min_points, "id").collect()
    label = {r["id"]: r["cluster"] for r in got}
    is_core = {r["id"]: r["core"] for r in got}
    core, groups, border = brute_density(points, eps, min_points)
    assert len(got) == len(points)
    assert [is_core[p[0]] for p in points] == list(core)
    names = {}
    for root, members in groups.items():
        found = {label[m] for m in members}
        assert len(found) == 1
        names[root] = found.pop()
    assert sorted(names.values()) == list(range(len(groups)))
    for point, roots in border.items():
        assert label[point] == (min(names[r] for r in roots) if roots else -1)


def test_density_blobs_with_copies(spark):
    rng = random.Random(3)
    points = [(i, rng.gauss(c, 0.15), rng.gauss(-c, 0.15)) for i, c in enumerate([0.0] * 120 + [2.0] * 60)]
    points += [(1000 + i, rng.uniform(-3, 5), rng.uniform(-5, 3)) for i in range(40)]
    points += [(2000 + i, 0.05, -0.03) for i in range(110)]  # a third of all rows in one spot
    points += [(3000 + i, 4.0, 4.0) for i in range(5)] + [(3100 + i, -4.0, 4.0) for i in range(4)]
    check_density(spark, points, 0.2, 5)


def test_density_gap_close_to_eps(spark):
    """Two long rows of points whose distance is just below, then just above the radius."""
    def rows(gap):
        left = [(i, 0.0, i * 0.01) for i in range(60)]
        return left + [(100 + i, gap, 0.005 + i * 0.01) for i in range(60)]

    reach = math.hypot(0.5, 0.005)
    for eps in (reach + 1e-7, reach - 1e-7):
        check_density(spark, rows(0.5), eps, 3)


def test_density_chain(spark):
    """A chain of many cells is one cluster."""
    points = [(i, i * 0.09, math.sin(i / 5)) for i in range(200)]
    check_density(spark, points, 0.3, 3)


def brute_silhouette(points):
    xy, labels = np.array([p[:2] for p in points]), np.array([p[2] for p in points])
    gaps = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2))
    values = []
    for i in range(len(points)):
        own = labels == labels[i]
        if own.sum() == 1:
            values.append(0.0)
            continue
        a = gaps[i, own].sum() / (own.sum() - 1)
        b = min(gaps[i, labels == c].mean() for c in set(labels) if c != labels[i])
        values.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(values))


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(8)
    rows = [(rng.gauss(c, 0.6), rng.gauss(c % 2, 0.6), c) for c in (0, 2, 4, -1) for _ in range(40)]
    rows += [(1.0, 1.0, 2)] * 60 + [(9.0, 9.0, 7)]
    return rows, spark.createDataFrame(rows, "x double, y double, cluster int")


def test_silhouette_matches_brute_force(blobs):
    rows, df = blobs
    want = brute_silhouette(rows)
    for tile in (2048, 16):
        assert indices.silhouette(df, ["x", "y"], tile_rows=tile).first()[0] == pytest.approx(want, abs=1e-9)


def test_indices_ignore_row_order(blobs):
    _, df = blobs
    one = indices.all_indices(df, ["x", "y"]).first()
    two = indices.all_indices(df.repartition(5, "x"), ["x", "y"]).first()
    assert list(one) == pytest.approx(list(two), abs=1e-9)


def test_identical_centroids_and_single_label(spark):
    same = spark.createDataFrame([(0.0, 1.0, 0), (0.0, -1.0, 0), (1.0, 0.0, 1), (-1.0, 0.0, 1)], "x double, y double, cluster int")
    assert indices.davies_bouldin(same, ["x", "y"]).first()[0] == math.inf
    assert list(indices.all_indices(same.withColumn("cluster", F.lit(3)), ["x", "y"]).first()) == [0.0, 0.0, 0.0]


def test_kmeans_cost_falls_with_k(blobs):
    _, df = blobs
    sweep = clusters.sweep_k(df.drop("cluster"), ["x", "y"], (2, 4), restarts=2).orderBy("k").collect()
    costs = [r["inertia"] for r in sweep]
    assert [r["k"] for r in sweep] == [2, 3, 4] and costs == sorted(costs, reverse=True)


def test_every_method_labels_every_point(spark, blobs):
    _, df = blobs
    keyed = df.select(F.monotonically_increasing_id().cast("string").alias("player"), "x", "y")
    for method in clusters.METHODS:
        labelled = clusters.cluster(keyed, method, 3, restarts=1).labelled
        assert labelled.count() == keyed.count()
        assert labelled.where("cluster is null").isEmpty()
    with pytest.raises(ValueError):
        clusters.cluster(keyed, "unknown")


def test_component_signs_and_variance(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 1))
    data = np.hstack([base + 0.1 * rng.normal(size=(300, 1)), -base, 0.3 * rng.normal(size=(300, 1))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    reduction = clusters.fit_reduction(df, ["a", "b", "c"])
    scaled = (data - data.mean(axis=0)) / data.std(axis=0)
    values = np.sort(np.linalg.eigvalsh(np.cov(scaled.T)))[::-1]
    assert reduction.explained == pytest.approx(list(values[:2] / values.sum()), abs=1e-9)
    assert all(max(w, key=abs) > 0 for w in reduction.loadings)
    spread = reduction.transform(df).agg(F.var_samp("x"), F.var_samp("y")).first()
    assert list(spread) == pytest.approx(list(values[:2]), abs=1e-9)


def test_preparation(spark):
    df = spark.createDataFrame(
        [("a", 1500.0, 1.0, 0.1, None), ("b", 1600.0, 3.0, 0.1, 4.0), ("c", 1700.0, None, 0.1, 8.0)],
        "player string, elo double, num_moves double, avg_time_opening double, avg_time_endgame double",
    )
    out, kept, missing = scaling.prepare_clustering(df)
    assert kept == ["avg_time_endgame", "num_moves"] and "piece_activity_score" in missing
    assert {r["player"]: (r["avg_time_endgame"], r["num_moves"]) for r in out.collect()} == {
        "a": (6.0, 1.0), "b": (4.0, 3.0), "c": (8.0, 2.0),
    }


def test_statistics_and_names(spark):
    rows = [("a", 1900.0, 10, "Advanced", 0), ("b", 1500.0, 6, "Intermediate", 1), ("c", 1500.0, 8, "Intermediate", 2),
            ("d", 1000.0, 5, "Beginner", 3), ("e", 1200.0, 5, "Beginner", -1)]
    df = spark.createDataFrame(rows, "player string, elo double, game_count int, skill_tier string, cluster int")
    stats = profiles.cluster_statistics(df, [])
    assert stats.agg(F.sum("pct_of_total")).first()[0] == pytest.approx(80.0)
    names = {r["cluster"]: r["name"] for r in profiles.name_clusters(stats).collect()}
    assert names == {0: "Time Scramblers", 1: "Positional Grinders", 2: "Tactical Battlers", 3: "Tactical Battlers"}
    placed = {r["player"]: r["archetype"] for r in profiles.with_archetype(df, profiles.name_clusters(stats)).collect()}
    assert placed["e"] is None and placed["d"] == "Tactical Battlers"
