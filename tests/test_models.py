from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyscope.operators import classifiers, metrics, reports, trees
from plyscope.operators.indices import block_distances
from plyscope.operators.oversample import nearest_in_class, nearest_rows, oversample
from plyscope.operators.scaling import fit_scaler

# A published confusion matrix and the scores that belong to it.
LABELS = ("Advanced", "Beginner", "Intermediate")
MATRIX = ((1197, 30, 566), (28, 1210, 512), (586, 577, 1986))


@pytest.fixture(scope="module")
def counts(spark):
    rows = [(a, p, n) for a, line in zip(LABELS, MATRIX) for p, n in zip(LABELS, line)]
    return spark.createDataFrame(rows, "actual string, predicted string, n long")


def test_published_scores(counts):
    row = metrics.scores_of_counts(counts).first()
    assert row["samples"] == 6692
    assert row["accuracy"] == pytest.approx(0.6564554692169755, abs=1e-12)
    assert row["macro_precision"] == pytest.approx(0.658355325085743, abs=1e-12)
    assert row["macro_recall"] == pytest.approx(0.663233728036694, abs=1e-12)
    assert row["macro_f1"] == pytest.approx(0.6606692940288431, abs=1e-12)
    assert row["adjacent_accuracy_alphabetical"] == pytest.approx(0.8278541542139869, abs=1e-12)
    assert row["adjacent_accuracy"] == pytest.approx(0.9913329348475792, abs=1e-12)


def test_matrix_report_and_shares(counts):
    matrix = metrics.confusion_matrix(counts, list(LABELS)).collect()
    assert [tuple(r)[1:] for r in matrix] == list(MATRIX)
    report = {r["label"]: r for r in metrics.full_report(counts).collect()}
    assert report["Beginner"]["recall"] == pytest.approx(1210 / 1750)
    assert report["weighted avg"]["support"] == report["accuracy"]["support"] == 6692
    assert report["weighted avg"]["recall"] == pytest.approx(report["accuracy"]["f1"])
    shares = metrics.confusion_shares(counts).groupBy("actual").agg(F.sum("share").alias("s")).collect()
    assert [r["s"] for r in shares] == pytest.approx([1.0] * 3)


def test_label_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "actual string, predicted string")
    report = {r["label"]: r for r in metrics.class_report(metrics.confusion_counts(df)).collect()}
    assert (report["b"]["precision"], report["b"]["recall"], report["b"]["f1"]) == (0.0, 0.0, 0.0)


def class_rows(spark, sizes, seed=1, copies=0):
    rng = random.Random(seed)
    rows = []
    for c, n in sizes.items():
        for i in range(n):
            point = (1.0, 1.0, 1.0) if i < copies else tuple(rng.gauss(ord(c) - 97, 1) for _ in range(3))
            rows.append((f"{c}{i}", c, *point))
    return rows, spark.createDataFrame(rows, "player string, label string, f0 double, f1 double, f2 double")


FEATURES = ["f0", "f1", "f2"]


def test_nearest_in_class_is_exact(spark):
    rows, df = class_rows(spark, {"a": 60, "b": 35}, copies=20)
    got = {
        r["key"]: r["neighbours"]
        for r in nearest_in_class(df, df, FEATURES, "label", "player", {"a": 60, "b": 35}, k=4, tile_rows=10).collect()
    }
    assert len(got) == len(rows)
    for key, label, *point in rows:
        others = sorted(
            (float(np.sqrt(sum((p - q) ** 2 for p, q in zip(point, other)))), k)
            for k, c, *other in rows
            if c == label and k != key
        )
        assert got[key] == [k for _, k in others[:4]]


def test_far_tiles_are_never_compared(spark):
    """On clustered rows the compared pairs grow far slower than the square, and the answer stays exact."""
    from plyscope.operators import oversample as o

    rng = np.random.default_rng(8)
    shares = []
    for n in (400, 1600):
        at = rng.integers(0, 12, n)
        x = rng.standard_normal((12, 3))[at] * 40 + rng.standard_normal((n, 3))
        df = spark.createDataFrame([(f"k{i:05}", "a", *map(float, v)) for i, v in enumerate(x)], "player string, label string, f0 double, f1 double, f2 double")
        got = {r["key"]: r["neighbours"] for r in nearest_in_class(df, df, FEATURES, "label", "player", {"a": n}, k=3, tile_rows=20).collect()}
        gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
        np.fill_diagonal(gaps, np.inf)
        for i in range(0, n, 7):
            order = sorted(range(n), key=lambda j: (gaps[i, j], j))[:3]
            assert got[f"k{i:05}"] == [f"k{j:05}" for j in order]
        left, right = o.placed_tiles(df, df, FEATURES, "label", "player", {"a": n}, {"a": o.tile_count(n, 20)})
        near = o._candidates(left.join(right, ["_class", "_cell"]), FEATURES, 3)
        pairs = o.tile_pairs(left, right, near, FEATURES, 3)
        compared = pairs.select(F.sum(F.size("q_key") * F.size("r_key"))).first()[0]
        shares.append(compared / n**2)
    assert shares[0] < 0.5 and shares[1] < 0.7 * shares[0], shares


def test_oversampling_balances(spark):
    rows, df = class_rows(spark, {"a": 40, "b": 13, "c": 7})
    out = oversample(df, FEATURES)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {"a": 40, "b": 40, "c": 40}
    assert out.where("not synthetic").count() == len(rows)
    assert out.select("player").distinct().count() == 120
    # synthetic rows lie within the box of their class
    box = df.groupBy("label").agg(F.min("f0").alias("low"), F.max("f0").alias("high"))
    assert out.join(box, "label").where("f0 < low - 1e-9 or f0 > high + 1e-9").isEmpty()
    again = oversample(df.repartition(3), FEATURES)
    assert out.exceptAll(again).isEmpty()


def test_oversampling_of_very_small_classes(spark):
    _, df = class_rows(spark, {"a": 20, "b": 5, "c": 1})
    grown = oversample(df, FEATURES)
    assert {r["label"]: r["count"] for r in grown.groupBy("label").count().collect()} == {"a": 20, "b": 20, "c": 20}
    assert grown.where("label = 'c'").select(*FEATURES).distinct().count() == 1


def test_scaler_uses_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = fit_scaler(df, ["a", "b"])
    assert scaler.means == (2.0, 5.0) and scaler.scales == (1.0, 1.0)
    assert [tuple(r) for r in scaler.transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_soft_vote_ties_take_the_first_label(spark):
    df = spark.createDataFrame([([0.5, 0.5, 0.0], [0.4, 0.4, 0.2])], "p array<double>, q array<double>")
    row = classifiers.soft_vote(df, ["p", "q"], list(LABELS)).first()
    assert row["predicted"] == "Advanced" and sum(row["probability"]) == pytest.approx(1.0)


SMALL = {"forest_params": {"numTrees": 8, "maxDepth": 4}, "boosted_params": {"maxIter": 3, "maxDepth": 2}}


def test_models_learn_save_and_compare(spark, tmp_path):
    _, df = class_rows(spark, {"a": 60, "d": 40, "g": 30})
    table = df.withColumnRenamed("label", "skill_tier")
    rows, results = classifiers.compare_models(table, FEATURES, **SMALL)
    scores = {r["model_type"]: r for r in rows.collect()}
    assert list(results) == list(classifiers.KINDS)
    assert all(r["test_accuracy"] > 0.8 for r in scores.values())
    best = classifiers.best_model(rows).first()
    top = max(r["test_accuracy"] for r in scores.values())
    assert best["test_accuracy"] == top
    assert best["position"] == min(r["position"] for r in scores.values() if r["test_accuracy"] == top)
    result = results[classifiers.ENSEMBLE]
    model = result.model
    scored = model.predict(table)
    sums = scored.select(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s"))
    assert list(sums.first()) == pytest.approx([1.0, 1.0])
    importances = model.importances(spark).collect()
    assert sum(r["importance"] for r in importances) == pytest.approx(1.0)
    assert [r["importance"] for r in importances] == sorted((r["importance"] for r in importances), reverse=True)
    assert {r["fold"]: r["rows"] for r in result.sizes.collect()} == {"train": 91, "val": 19, "test": 20}
    model.save(str(tmp_path / "m"))
    again = classifiers.load_model(spark, str(tmp_path / "m")).predict(table)
    assert scored.select("player", "predicted").exceptAll(again.select("player", "predicted")).isEmpty()


def test_larger_tables_grow_their_forest_in_tasks(spark, tmp_path, monkeypatch):
    """Beyond ``ML_ROWS`` no Spark ML forest is fitted; all kinds score, are saved and come back."""
    _, df = class_rows(spark, {"a": 60, "d": 40, "g": 30})
    monkeypatch.setattr(classifiers, "ML_ROWS", 100)
    monkeypatch.setattr(classifiers, "RandomForestClassifier", None)
    rows, results = classifiers.compare_models(df.withColumnRenamed("label", "skill_tier"), FEATURES, **SMALL)
    assert all(r["test_accuracy"] > 0.8 for r in rows.collect())
    model = results[classifiers.FOREST].model
    assert isinstance(model.forest, trees.TaskForest) and model.boosted is None
    assert sum(r["importance"] for r in model.importances(spark).collect()) == pytest.approx(1.0)
    model.save(str(tmp_path / "m"))
    again = classifiers.load_model(spark, str(tmp_path / "m")).predict(df)
    scored = model.predict(df)
    assert scored.columns == [*df.columns, "probability", "predicted"] and scored.count() == 130
    assert scored.select("player", "predicted").exceptAll(again.select("player", "predicted")).isEmpty()
    # parameters that only Spark ML knows are not passed over
    with pytest.raises(TypeError):
        classifiers.fit_model(df, FEATURES, ["a", "d", "g"], forest_params={"numTrees": 2, "maxBins": 8})


@pytest.mark.parametrize("kind", ["spread", "ties", "copies", "far", "unknown"])
def test_near_rows_are_those_of_a_full_sort(kind):
    """Only pairs that may be among the answer are measured; order, ties and distances are those of all pairs."""
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((60, 6)), rng.standard_normal((80, 6))
    if kind == "ties":
        a, b = np.round(a), np.round(b)
    elif kind == "copies":
        a[:30], b[:] = b[0], b[0]
    elif kind == "far":
        a, b = a + 1e8, b + 1e8
    elif kind == "unknown":
        a[2, 0] = b[3, 1] = np.nan
    gaps = block_distances(a, b)
    for bounds in (None, np.where(rng.random(60) < 0.2, np.inf, rng.random(60) * 3)):
        i, j, distance = nearest_rows(a, b, 6, bounds)
        best = np.argsort(gaps, axis=1, kind="stable")[:, :6]
        wanted = [(r, c, gaps[r, c]) for r in range(60) for c in best[r] if bounds is None or not gaps[r, c] > bounds[r]]
        assert len(i) == len(wanted) and np.array_equal(np.column_stack([i, j, distance]), np.array(wanted), equal_nan=True)


def test_class_weights_instead_of_synthetic_rows(spark):
    _, df = class_rows(spark, {"a": 60, "d": 12})
    model = classifiers.fit_model(df, FEATURES, ["a", "d"], balance="weights", **SMALL)
    assert model.predict(df).where("label = predicted").count() > 60


def test_boosted_trees_use_class_weights(spark):
    rows = [(f"p{i}", "d" if i % 10 == 0 else "a", float(i % 7)) for i in range(400)]  # the feature says nothing
    df = spark.createDataFrame(rows, "player string, label string, x double")
    params = {"boosted_params": {"maxIter": 3, "maxDepth": 2}}
    model = classifiers.fit_model(df, ["x"], ["a", "d"], classifiers.BOOSTED, balance="weights", **params)
    share = model.predict(df).agg(F.avg(F.col("probability")[1])).first()[0]
    assert share == pytest.approx(0.5, abs=0.1)


def test_grid_search(spark):
    _, df = class_rows(spark, {"a": 40, "d": 30, "g": 20})
    table = df.withColumnRenamed("label", "skill_tier")
    for kind, grid in (
        (classifiers.FOREST, {"numTrees": [2, 5], "maxDepth": [2]}),
        (classifiers.BOOSTED, {"maxIter": [2], "maxDepth": [2, 3]}),
    ):
        _, results = classifiers.tune(table, FEATURES, kind, grid=grid, folds=2)
        accuracies = [r["accuracy"] for r in results.collect()]
        assert len(accuracies) == 2 and accuracies == sorted(accuracies, reverse=True)


def test_importance_labels(spark):
    df = spark.createDataFrame([("white_avg_time_opening", 0.2), ("num_moves", 0.5)], "feature string, importance double")
    got = reports.top_importances(df, 1).first()
    assert (got["feature"], got["label"]) == ("num_moves", "Num Moves")
    assert reports.top_importances(df).collect()[1]["label"] == "Avg Time Opening"


@pytest.mark.parametrize("group", [1, 40, 1000])
def test_large_classes_read_tiles_instead_of_joining_pairs(spark, monkeypatch, group):
    """No pair of tiles is made or moved; the neighbours are those of all pairs, copies and ties included."""
    from plyscope.operators import oversample as o

    rows, _ = class_rows(spark, {"a": 150, "b": 70}, copies=30)
    rows = [(k, c, x, float(round(y)), z) for k, c, x, y, z in rows]
    df = spark.createDataFrame(rows, "player string, label string, f0 double, f1 double, f2 double")
    monkeypatch.setattr(o, "PAIRED_ROWS", 100)
    monkeypatch.setattr(o, "GROUP_ROWS", group)
    monkeypatch.setattr(o, "FIRST_CELLS", 2)
    monkeypatch.setattr(o, "BATCH_TILES", 3)
    monkeypatch.setattr(o, "tile_pairs", None)
    some = df.where("crc32(player) % 3 > 0")
    got = {r["key"]: r["neighbours"] for r in o.nearest_in_class(some, df, FEATURES, "label", "player", {"a": 150, "b": 70}, k=4, tile_rows=10).collect()}
    assert len(got) == some.count()
    for key, label, *point in rows:
        if key in got:
            others = sorted((float(np.sqrt(sum((p - q) ** 2 for p, q in zip(point, other)))), k) for k, c, *other in rows if c == label and k != key)
            assert got[key] == [k for _, k in others[:4]]
