"""Histogram trees: a split by hand, prefixes, and many blocks against one."""

from __future__ import annotations

import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyscope.operators import classifiers, trees

COLUMNS = [f"f{j}" for j in range(5)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 260)
    x = rng.standard_normal((260, 5))
    x[:, 0] += y
    x[:, 1] += 2 * (y == 1)
    x = np.round(x, 1)  # ties
    rows = [(f"k{i}", "abc"[y[i]], int(y[i]), *map(float, x[i])) for i in range(260)]
    names = ", ".join(f"{c} double" for c in COLUMNS)
    return spark.createDataFrame(rows, f"player string, skill_tier string, code int, {names}"), x, y


def packed(df, monkeypatch=None, rows=None):
    if rows:
        monkeypatch.setattr(trees, "BLOCK_ROWS", rows)
    edges = trees.bin_edges(df, COLUMNS)
    return trees.blocks(df, COLUMNS, "code", None, "player", edges, 3), edges


def test_first_round_splits_as_computed_by_hand(table):
    df, x, y = table
    data, edges = packed(df)
    model = trees.fit_boosted(data, edges, 3, 1, 1, 0.5)
    p = 1 / 3
    for c, tree in enumerate(model.trees):
        g, h = p - (y == c), np.full(len(y), 2 * p * (1 - p))
        best = (0.0, None, None)
        for j, b in itertools.product(range(5), range(31)):
            if b >= len(edges[j]):
                continue
            left = x[:, j] <= edges[j][b]
            score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
            if min(h[left].sum(), h[~left].sum()) < 1:
                continue
            gain = score(left) + score(~left) - score(np.ones(len(y), bool))
            if gain > best[0] + 1e-9:
                best = (gain, j, b)
        assert (tree.feature[0], tree.cut[0]) == best[1:] and tree.gain[0] == pytest.approx(best[0])
        left = x[:, best[1]] <= edges[best[1]][best[2]]
        want = [-0.5 * g[m].sum() / (h[m].sum() + 1) for m in (left, ~left)]
        assert model._leaf(tree)[1:].tolist() == pytest.approx(want)


def test_many_blocks_grow_the_trees_of_one(table, monkeypatch):
    df, x, y = table
    one, edges = packed(df)
    many, again = packed(df, monkeypatch, 60)
    assert edges == again and one.count() == 1 and many.count() > 3
    monkeypatch.setattr(trees, "KEEP_MARGINS", 2)
    monkeypatch.setattr(trees, "CELLS", 2000)  # several batches of nodes a level
    fits = [
        lambda d: trees.fit_forest(d, edges, 3, 4, 4, 2),
        lambda d: trees.fit_boosted(d, edges, 3, 5, 3, 0.3, 0.8, 0.7),
    ]
    for fit in fits:
        a, b = fit(one), fit(many)
        assert [(t.feature, t.cut, t.left) for t in a.trees] == [(t.feature, t.cut, t.left) for t in b.trees]
        bins = trees.to_bins(x, edges)
        assert np.allclose(a.probabilities(bins), b.probabilities(bins))
        assert (a.probabilities(bins).argmax(axis=1) == y).mean() > 0.7


def test_prefixes_equal_shorter_fits(table):
    df, x, _ = table
    data, edges = packed(df)
    bins = trees.to_bins(x, edges)
    forest = trees.fit_forest(data, edges, 3, 12, 8, 1)
    assert np.allclose(forest.probabilities(bins, 5, 3), trees.fit_forest(data, edges, 3, 5, 3, 1).probabilities(bins))
    boosted = trees.fit_boosted(data, edges, 3, 9, 3, 0.2)
    assert np.allclose(boosted.probabilities(bins, 4), trees.fit_boosted(data, edges, 3, 4, 3, 0.2).probabilities(bins))


@pytest.mark.parametrize(
    "kind,grid",
    [
        (classifiers.FOREST, {"numTrees": [3, 8], "maxDepth": [2, 5], "minInstancesPerNode": [1, 4]}),
        (classifiers.BOOSTED, {"maxIter": [2, 5], "maxDepth": [2, 3], "stepSize": [0.1, 0.4]}),
    ],
)
def test_grid_equals_single_fits(table, kind, grid):
    df, _, _ = table
    model, results = classifiers.tune(df, COLUMNS, kind, grid=grid, folds=3)
    got = {r["params"]: r["accuracy"] for r in results.collect()}
    assert len(got) == 8
    for values in itertools.product(*grid.values()):
        single = {n: [v] for n, v in zip(grid, values)}
        _, one = classifiers.tune(df, COLUMNS, kind, grid=single, folds=3)
        row = one.first()
        assert got[row["params"]] == pytest.approx(row["accuracy"]) and json.loads(row["params"]) == dict(zip(grid, values))
    assert model.predict(df).where("predicted = skill_tier").count() > 200


def test_missing_values_and_one_class(spark):
    rows = [("a", 0, None), ("b", 0, float("nan")), ("c", 0, 1.0), ("d", None, 2.0)]
    df = spark.createDataFrame(rows, "player string, code int, f0 double")
    edges = trees.bin_edges(df, ["f0"])
    data = trees.blocks(df, ["f0"], "code", None, "player", edges, 1)
    model = trees.fit_boosted(data, edges, 1, 2, 2, 0.1)
    assert model.probabilities(np.zeros((1, 1), np.uint8)).tolist() == [[1.0]]
    assert trees.fit_forest(data, edges, 1, 2, 2, 1).probabilities(np.zeros((1, 1), np.uint8)).tolist() == [[1.0]]


def test_few_rows_split_as_their_histograms():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 32, (700, 9)).astype(np.uint8)
    draws, y = rng.poisson(1.0, 700), rng.integers(0, 3, 700)
    stats = np.column_stack([*[draws * (y == c) for c in range(3)], draws, draws]).astype(float)
    growth = trees.Growth(12, 3, 9, 3, True, 1)
    for least in (1, 3):
        some = trees.replace(growth, least_rows=least)
        node = rng.integers(0, 90, 700)
        node[:90] = np.arange(90)
        chosen = some.all_candidates(4, list(range(1, 91)))
        assert [c.tolist() for c in chosen] == [some.candidates(4, p).tolist() for p in range(1, 91)]
        wide = some.best(some.histograms(x, stats, node, 90, chosen), chosen)
        lean = some.best_of_rows(x, stats, node, 90, chosen)
        split = wide[2] > 0
        assert split.any() and (lean[2] == wide[2]).all()
        assert all((a[split] == b[split]).all() for a, b in zip(wide, lean, strict=True))


def test_grid_keeps_no_forest_at_the_driver(table, monkeypatch):
    """The search scores in the tasks that grow the trees; the best forest is read when it is asked for."""
    df, _, _ = table
    monkeypatch.setattr(trees, "fit_forest", None)
    collected, read = [], trees._collected
    monkeypatch.setattr(trees, "_collected", lambda rows: collected.append(1) or read(rows))
    grid = {"numTrees": [2, 4], "maxDepth": [2, 6], "minInstancesPerNode": [2]}
    model, results = classifiers.tune(df, COLUMNS, classifiers.FOREST, grid=grid, folds=2)
    assert results.count() == 4 and not collected
    assert model.predict(df).where("predicted = skill_tier").count() > 180 and len(collected) == 1


@pytest.mark.parametrize("rows", [None, 60])
def test_forest_in_tasks_votes_as_the_one_at_the_driver(spark, table, monkeypatch, tmp_path, rows):
    """One block or several: the same trees, none of them collected, stored and read again."""
    df, x, y = table
    data, edges = packed(df, monkeypatch, rows)
    whole = trees.fit_forest(data, edges, 3, 5, 6, 2)
    monkeypatch.setattr(trees, "_collected", None)
    held = trees.TaskForest.fit(data, edges, 3, 5, 6, 2)
    wanted = whole.probabilities(trees.to_bins(x, edges))
    held.save(str(tmp_path / "forest"))
    for forest in (held, trees.TaskForest.load(spark, str(tmp_path / "forest"))):
        scored = forest.transform(df.select("player", *COLUMNS), F.array(*COLUMNS), "p")
        assert scored.columns == ["player", *COLUMNS, "p"]
        got = {r["player"]: r["p"] for r in scored.collect()}
        assert np.allclose([got[f"k{i}"] for i in range(len(y))], wanted)
    shares = []
    for t in whole.trees:
        f, gain = np.asarray(t.feature), np.asarray(t.gain)
        total = np.bincount(f[f >= 0], gain[f >= 0], len(COLUMNS))
        shares.append(total / total.sum())
    assert np.allclose(held.importances(), np.mean(shares, axis=0))


def test_histograms_are_sums_over_rows():
    rng = np.random.default_rng(1)
    for per_node in (False, True):
        growth = trees.Growth(4, 1, 6, 4, per_node)
        x, node, stats = rng.integers(0, 32, (500, 6), dtype=np.uint8), rng.integers(0, 3, 500), rng.random((500, 3))
        chosen = growth.all_candidates(7, [1, 2, 3])
        hist = growth.histograms(x, stats, node, 3, chosen)
        for n, c, b in itertools.product(range(3), range(4), range(32)):
            assert np.allclose(hist[n, c, b], stats[(node == n) & (x[:, chosen[n, c]] == b)].sum(axis=0))


def test_class_counts_grow_the_same_trees():
    """Unit weights: one sort or count of whole numbers a level instead of sums of columns; sums, gains and ties alike."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 32, (900, 7)).astype(np.uint8)
    x[:, 3] = x[:, 2]  # ties between candidates
    y, draws = (x[:, 0] // 11 + rng.integers(0, 2, 900)) % 3, rng.poisson(1.0, 900)
    stats = np.column_stack([*[draws * (y == c) for c in range(3)], draws, draws])
    names = ("feature", "cut", "left", "gain", "depth", "path", "sums")
    for least, depth, drawn in ((1, 30, 3), (5, 4, 7), (2, 12, 2)):
        growth = trees.Growth(depth, 3, 7, drawn, True, least)
        for dense in (0, 8, 10_000):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(trees, "DENSE_ROWS", dense)
                patch.setattr(trees, "COUNTED_ROWS", 100)
                for path in (1, 5):
                    wanted = growth.grow(trees.Tree(9, path=[path], depth=[2]), x, stats.astype(float))
                    for got in (growth.grow_counts(9, x, y, draws, path, 2), growth.grow_rows(trees.Tree(9, path=[path], depth=[2]), x, stats.astype(np.uint8))):
                        assert all(np.array_equal(getattr(wanted, n), getattr(got, n)) for n in names) and max(got.depth) > 3
    assert growth.grow_counts(1, x[:0], y[:0], draws[:0]).sums.tolist() == [[0.0] * 5]


def test_grid_over_several_blocks_needs_no_forest_at_the_driver(table, monkeypatch):
    """A table of several blocks is scored in the tasks that grow its trees, as one of a single block."""
    df, _, _ = table
    grid = {"numTrees": [3, 25], "maxDepth": [2, 6], "minInstancesPerNode": [1, 3]}
    _, wanted = classifiers.tune(df, COLUMNS, classifiers.FOREST, grid=grid, folds=2)
    monkeypatch.setattr(trees, "BLOCK_ROWS", 60)
    for name in ("fit_forest", "grow_all", "_upper", "_collected"):
        monkeypatch.setattr(trees, name, None)
    _, results = classifiers.tune(df, COLUMNS, classifiers.FOREST, grid=grid, folds=2)
    got, wanted = ({r["params"]: r["accuracy"] for r in rows.collect()} for rows in (results, wanted))
    assert len(got) == 8 and got == pytest.approx(wanted)


def test_forest_over_many_blocks_sends_some_trees_at_a_time(table, monkeypatch):
    """More blocks than a task reads: the same trees, whose rows are sent for a few of them at a time."""
    df, x, y = table
    data, edges = packed(df, monkeypatch, 60)
    grown = {t.number: t for t in trees.fit_forest(data, edges, 3, 5, 6, 2).trees}
    monkeypatch.setattr(trees, "TABLE_BLOCKS", 1)
    monkeypatch.setattr(trees, "SENT_TREES", 2)
    sent, below = [], trees._below
    monkeypatch.setattr(trees, "_below", lambda data, growth, grown, few, stats_of: sent.append({i for i, _ in few}) or below(data, growth, grown, few, stats_of))
    stored = trees.stored_forest(data, edges, 3, 5, 6, 2)
    assert sent == [{0, 1}, {2, 3}, {4}]
    at_driver = trees.fit_forest(data, edges, 3, 5, 6, 2)
    for forest in (stored, at_driver):
        for t in forest.trees:
            assert [t.feature, t.cut, t.left, t.sums] == [grown[t.number].feature, grown[t.number].cut, grown[t.number].left, grown[t.number].sums]
