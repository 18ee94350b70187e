from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from plyscope.operators import clusters, multistart


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    centers = np.array([[0, 0, 0], [6, 0, 1], [0, 7, 2], [5, 6, 9]])
    x = centers[rng.integers(0, 4, 500)] + rng.standard_normal((500, 3))
    rows = [(f"p{i}", *map(float, v)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "player string, x double, y double, z double")


XYZ = ["x", "y", "z"]


def lloyd(x, centers, passes=300):
    centers = centers.copy()
    for _ in range(passes):
        at, gap = multistart.nearest(x, centers)
        moved = np.array([x[at == c].mean(axis=0) if (at == c).any() else centers[c] for c in range(len(centers))])
        if ((moved - centers) ** 2).sum() <= multistart.REST * x.var(axis=0).mean():
            return moved, multistart.nearest(x, moved)[1].sum()
        centers = moved
    return centers, gap.sum()


def test_runs_share_passes_and_equal_single_runs(cloud, monkeypatch):
    x, df = cloud
    calls = []
    whole = multistart._pass
    monkeypatch.setattr(multistart, "_pass", lambda b, j: calls.append(len(j)) or whole(b, j))
    starts = [(k, s) for k in (2, 3, 4) for s in (1, 2, 3)]
    together = multistart.multi_start(df, XYZ, starts)
    assert len(calls) <= max(r.passes for r in together) + 2 + multistart.STEPS
    monkeypatch.setattr(multistart, "BLOCK_ROWS", 90)  # several blocks
    for run in together:
        (alone,) = multistart.multi_start(df.repartition(5), XYZ, [(run.k, run.seed)])
        assert np.allclose(alone.centers, run.centers) and alone.cost == pytest.approx(run.cost)
        assert alone.passes == run.passes and run.converged
        at, gap = multistart.nearest(x, run.centers)
        assert run.cost == pytest.approx(gap.sum())


def test_cost_is_not_above_brute_force_restarts(cloud):
    x, df = cloud
    rng = np.random.default_rng(0)
    for k, run in multistart.best_runs(df, XYZ, (2, 4), restarts=6).items():
        brute = min(lloyd(x, x[rng.choice(len(x), k, replace=False)])[1] for _ in range(30))
        assert run.cost <= brute * 1.001


def test_weights_stand_for_copies(cloud, spark):
    x, _ = cloud
    rows = [(*map(float, v), 1.0 + i % 3) for i, v in enumerate(x)]
    weighted = spark.createDataFrame(rows, "x double, y double, z double, n double")
    copies = spark.createDataFrame([r[:3] for r in rows for _ in range(int(r[3]))], "x double, y double, z double")
    a = multistart.best_runs(weighted, XYZ, [4], restarts=4, weight="n")[4]
    b = multistart.best_runs(copies, XYZ, [4], restarts=4)[4]
    assert a.cost == pytest.approx(b.cost, rel=1e-3)


def test_few_points_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 1.0), ("c", 2.0, 2.0), ("d", None, 1.0), ("e", float("nan"), 0.0)], "player string, x double, y double")
    run = multistart.best_runs(df, ["x", "y"], [3], restarts=2)[3]
    assert sorted(map(tuple, run.centers)) == [(1.0, 1.0), (2.0, 2.0)] and run.cost == 0
    got = {r["player"]: r["cluster"] for r in clusters.cluster(df, "kmeans", 3).labelled.collect()}
    assert got["a"] == got["b"] != got["c"] and got["d"] is None
    assert multistart.multi_start(df.limit(0), ["x", "y"], [(2, 1)])[0].centers.shape == (0, 2)


def test_model_of_centers_is_saved_and_labels_alike(cloud, tmp_path):
    x, df = cloud
    result = clusters.cluster(df, "kmeans", 4, XYZ, restarts=3)
    result.model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df)
    want = multistart.nearest(x, np.array(result.centers))[0]
    for labelled in (result.labelled, again):
        assert [r["cluster"] for r in sorted(labelled.collect(), key=lambda r: int(r["player"][1:]))] == want.tolist()


def test_sweep_and_grid_fit_all_k_together(cloud):
    _, df = cloud
    rows = {r["k"]: r for r in clusters.sweep_k(df, XYZ, (2, 5), restarts=3).collect()}
    assert sorted(rows) == [2, 3, 4, 5] and rows[2]["inertia"] > rows[3]["inertia"] > rows[4]["inertia"]
    for k, row in rows.items():
        assert row["inertia"] == pytest.approx(multistart.best_runs(df, XYZ, [k], restarts=3)[k].cost)
