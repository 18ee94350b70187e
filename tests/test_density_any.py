from __future__ import annotations

import hashlib

import numpy as np
import pytest

from plyscope.operators import clusters, density, density_any


def brute(x, keys, eps, least):
    near = np.zeros((len(x), len(x)))
    for j in range(x.shape[1]):
        near += (x[:, j][:, None] - x[:, j][None]) ** 2
    near = near <= eps * eps
    core = near.sum(axis=1) >= least
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] < 0:
            label[i], todo = i, [i]
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core & (label < 0)):
                    label[j] = i
                    todo.append(j)
    firsts = {g: min(keys[i] for i in np.flatnonzero(label == g)) for g in set(label[core])}
    order = {g: n for n, g in enumerate(sorted(firsts, key=lambda g: hashlib.md5(str(firsts[g]).encode()).hexdigest()))}
    out = {}
    for i, k in enumerate(keys):
        reached = [order[label[j]] for j in np.flatnonzero(near[i] & core)]
        out[k] = (order[label[i]] if core[i] else min(reached, default=-1), bool(core[i]))
    return out


def table(spark, x, keys):
    names = ", ".join(f"c{j} double" for j in range(x.shape[1]))
    return spark.createDataFrame([(k, *map(float, v)) for k, v in zip(keys, x)], f"player long, {names}")


@pytest.mark.parametrize("d,eps", [(2, 0.35), (5, 1.3), (11, 2.9)])
def test_equals_brute_force(spark, d, eps):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((300, d)) * 0.8 + rng.integers(0, 3, 300)[:, None] * 3
    x[40:60] = x[5]  # copies
    keys = [int(k) for k in rng.permutation(300)]
    df = table(spark, x, keys)
    coords = [f"c{j}" for j in range(d)]
    want = brute(x, keys, eps, 6)
    assert len({c for c, _ in want.values()}) > 2
    for rows in (16, 2048):
        found = density_any.density_clusters_any(df, coords, eps, 6, part_rows=rows).collect()
        assert {r["player"]: (r["cluster"], r["core"]) for r in found} == want
    if d == 2:
        plane = density.density_clusters(df, eps, 6, "player", *coords).collect()
        assert {r["player"]: (r["cluster"], r["core"]) for r in plane} == want
    else:
        got = clusters.cluster(df, "dbscan", coords=coords, eps=eps, min_points=6).labelled.collect()
        assert {r["player"]: r["cluster"] for r in got} == {k: c for k, (c, _) in want.items()}


def test_points_of_a_hot_location_are_labelled_where_they_lie(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 3)) * 5
    x[:120] = x[0]
    df = table(spark, x, list(range(200)))
    monkeypatch.setattr(density_any, "HOT", 20)
    labelled = spark.createDataFrame([([0.0], 50, 1, True), ([1.0], 3, 2, False)], "_v array<double>, copies long, cluster long, core boolean")
    points = spark.createDataFrame([(i, [0.0 if i < 50 else float(i % 3)]) for i in range(60)], "i long, _v array<double>")
    out = density_any.with_labels(points, labelled, ["_v"], hot=20)
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString() and out.count() == 60
    got = {r["i"]: r["cluster"] for r in out.collect()}
    assert got[0] == 1 and got[52] == 2 if 52 % 3 == 1 else got[52] in (1, -1)
    found = {r["player"]: r["cluster"] for r in density_any.density_clusters_any(df, ["c0", "c1", "c2"], 0.5, 5).collect()}
    assert {found[i] for i in range(120)} == {0}


def test_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, None, 0.0, 1.0), (2, float("nan"), 0.0, 1.0), (3, 1.0, 1.0, 1.0)], "player long, a double, b double, c double")
    got = {r["player"]: (r["cluster"], r["core"]) for r in density_any.density_clusters_any(df, ["a", "b", "c"], 1.0, 1).collect()}
    assert got == {1: (-1, False), 2: (-1, False), 3: (0, True)}
    assert density_any.density_clusters_any(df.limit(0), ["a", "b", "c"]).collect() == []
