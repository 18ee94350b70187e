"""The registered model and cluster queries run at the defaults of the operators, and share what they fit."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from plyscope.operators import classifiers, clusters, scaling
from verification import queries_clusters, tables

CUTS = {"forest_params", "boosted_params", "grid", "folds", "restarts", "ks"}
MODELS = ["C05_random_forest", "C06_boosted_trees", "C07_soft_ensemble", "C15_feature_importance", "C17_grid_search", "C18_saved_model", "C19_batch_scoring", "C20_model_comparison"]
CLUSTERS = ["K06_kmeans", "K10_micro_cluster_kmeans", "K16_k_sweep", "K17_method_comparison", "K22_player_map", "K23_saved_cluster_model", "K28_silhouette_grid"]


class Reached(Exception):
    pass


@pytest.mark.parametrize("name", MODELS + CLUSTERS)
def test_no_query_cuts_its_fit(monkeypatch, name):
    seen = []
    spark, rows = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="none")), SimpleNamespace(columns=[])

    def record(*args, **options):
        seen.append((len(args), set(options)))
        raise Reached

    monkeypatch.setattr(tables, "_MADE", {})
    for module in (tables, queries_clusters):
        monkeypatch.setattr(module, "stored_players", lambda *_: rows)
    monkeypatch.setattr(queries_clusters, "stored", lambda df, _: df)
    monkeypatch.setattr(queries_clusters, "style_map", lambda *_: (rows, [], SimpleNamespace(explained=[1.0])))
    monkeypatch.setattr(scaling, "prepare_clustering", lambda *_: (rows, [], None))
    for module, names in ((classifiers, ("fit_model", "train_classifier", "compare_models", "tune")), (clusters, ("cluster", "sweep_k", "compare_methods", "silhouette_grid"))):
        for function in names:
            monkeypatch.setattr(module, function, record)
    with pytest.raises(Reached):
        entry.queries()[name](spark, "none")
    assert len(seen) == 1 and not seen[0][1] & CUTS


def test_fits_are_shared(monkeypatch):
    monkeypatch.setattr(tables, "_MADE", {})
    spark, calls = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="none")), []
    for folder in ("some", "some", "other"):
        assert tables.once(spark, folder, "x", lambda: calls.append(1) or len(calls)) == len(calls)
    assert len(calls) == 2


def test_players_are_written_once(monkeypatch):
    monkeypatch.setattr(tables, "_MADE", {})
    made = []
    monkeypatch.setattr(tables, "players", lambda *_, **options: made.append(options))
    monkeypatch.setattr(tables, "stored", lambda df, name: (len(made), name))
    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="none"))
    assert tables.stored_players(spark, "a") == tables.stored_players(spark, "a") == (1, "players")
    assert tables.stored_players(spark, "a", min_games=9) == (2, "players") and len(made) == 2
