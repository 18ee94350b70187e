"""The whole analysis: games -> features -> players -> tiers and archetypes -> tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from plyscope.functions.tiers import tier_of
from plyscope.operators import classifiers, clusters, profiles, reports, scaling
from plyscope.operators.games import game_features, with_clock_data
from plyscope.operators.players import dashboard_profiles, folded_feature_names, player_profiles, profile_features
from plyscope.operators.profiling import dataset_stats
from plyscope.schema import MIN_GAMES, STYLE_FEATURES
from plyscope.sources import tables
from plyscope.sources.stages import StageCache

MAIN_METHOD = "kmeans"
MAIN_K = 3


def tier_phase_heatmap(full_games: DataFrame, decimals: int | None = 2) -> DataFrame:
    """Flagship: mean seconds per move by tier and game phase, straight from the clocks."""
    rated = full_games.withColumn("white_skill_tier", tier_of(F.col("white_elo")))
    return reports.tier_phase_time(game_features(rated), decimals)


@dataclass
class Analysis:
    games: DataFrame
    features: DataFrame
    players: DataFrame
    comparison: DataFrame
    best: classifiers.TrainingResult
    methods: DataFrame
    sweep: DataFrame
    labelled: DataFrame
    statistics: DataFrame
    names: DataFrame
    summary: DataFrame


def summary_record(
    games: DataFrame,
    features: DataFrame,
    players: DataFrame,
    scores: DataFrame,
    indices: DataFrame,
    names: DataFrame,
    source: str = "",
) -> DataFrame:
    """One nested row: data set, features, classification, clustering."""
    stats = dataset_stats(games)
    n_players = players.agg(F.count(F.lit(1))).scalar()

    def one(df, column):
        return df.select(column).scalar()

    return games.sparkSession.range(1).select(
        F.struct(
            one(stats, "total_games").alias("total_games"),
            n_players.alias("unique_players"),
            F.concat_ws(" - ", one(stats, "min_rating"), one(stats, "max_rating")).alias("rating_range"),
            F.lit(source).alias("data_source"),
        ).alias("dataset"),
        F.struct(
            F.lit(len(features.columns)).alias("game_level_features"),
            F.lit(len(players.columns)).alias("player_level_features"),
            n_players.alias("players_analyzed"),
        ).alias("features"),
        F.struct(
            one(scores, "model_type").alias("model_type"),
            one(scores, "test_accuracy").alias("test_accuracy"),
            one(scores, "adjacent_accuracy").alias("adjacent_accuracy"),
            one(scores, "macro_f1").alias("macro_f1"),
        ).alias("classification"),
        F.struct(
            one(indices, "method").alias("method"),
            one(indices, "n_clusters").alias("n_clusters"),
            one(indices, "silhouette_score").alias("silhouette_score"),
            names.agg(F.sort_array(F.collect_list(F.struct("cluster", "name")))).scalar().alias("archetypes"),
        ).alias("clustering"),
    )


def analyse(
    spark: SparkSession,
    full_games: DataFrame,
    out: str,
    positions: DataFrame | None = None,
    min_games: int = MIN_GAMES,
    force: bool = False,
    kinds=classifiers.KINDS,
    squared_silhouette: bool = True,
    source: str = "",
    restarts: int = clusters.RESTARTS,
    **fit_options,
) -> Analysis:
    """Run everything and store every result below ``out``.

    Stage tables are written once and read back, so a later stage never recomputes an
    earlier one and a lost executor costs one task. Features and profiles are stages of a cache below ``out`` that knows
    the files they come from: a run over the same games reuses them, changed games or options make new ones. ``squared_silhouette=False`` asks for the
    Euclidean index, which compares all pairs of players.
    """
    usable = with_clock_data(full_games)
    cache = StageCache(spark, f"{out}/stages")
    given = [full_games] if positions is None else [full_games, positions]
    sources = [d for d in given if d.inputFiles()]
    anew = force or len(sources) < len(given)  # tables that lie in no file are not known again
    features = cache.table("game_features", lambda: game_features(usable, positions), sources, force=anew)
    players = cache.table("player_profiles", lambda: player_profiles(features, min_games), [features], {"min_games": min_games}, force)
    columns = profile_features(folded_feature_names(features))
    comparison, results = classifiers.compare_models(players, columns, kinds, **fit_options)
    comparison = tables.materialise(comparison, spark, f"{out}/model_comparison", True)
    best_kind = classifiers.best_model(comparison).first()["model_type"]
    for kind, result in results.items():
        result.model.save(f"{out}/models/{kind}")
        tables.write_csv(result.confusion, f"{out}/confusion/{kind}")
        tables.write_csv(result.model.importances(spark), f"{out}/importance/{kind}")
        tables.write_json(result.report, f"{out}/report/{kind}")
    tables.write_json(comparison, f"{out}/metrics")

    style, kept, missing = scaling.prepare_clustering(players, STYLE_FEATURES)
    if missing:
        print(f"clustering features not present: {missing}")
    reduction = clusters.fit_reduction(style, kept)
    points = tables.materialise(reduction.transform(style), spark, f"{out}/player_map", True)
    sweep = tables.materialise(
        clusters.sweep_k(points, ["x", "y"], restarts=restarts, squared=squared_silhouette),
        spark, f"{out}/k_sweep", True,
    )
    methods = tables.materialise(
        clusters.compare_methods(
            points, MAIN_K, explained=sum(reduction.explained), squared=squared_silhouette, restarts=restarts
        ),
        spark, f"{out}/method_comparison", True,
    )
    main = clusters.cluster(points, MAIN_METHOD, MAIN_K, restarts=restarts)
    labelled = tables.materialise(main.labelled, spark, f"{out}/player_clusters", True)
    main.model.write().overwrite().save(f"{out}/models/clustering")
    reduction.pipeline.write().overwrite().save(f"{out}/models/reduction")
    statistics = profiles.cluster_statistics(labelled, kept)
    names = profiles.name_clusters(statistics)
    tables.write_csv(statistics, f"{out}/cluster_statistics")
    tables.write_json(names, f"{out}/cluster_names")
    tables.write_embedding(labelled, f"{out}/embedding")
    tables.write_table(
        dashboard_profiles(players).join(labelled.select("player", "x", "y", "cluster"), "player"),
        f"{out}/dashboard_players",
    )
    summary = summary_record(
        usable,
        features,
        players,
        comparison.where(F.col("model_type") == best_kind),
        methods.where(F.col("method") == MAIN_METHOD),
        names,
        source,
    )
    tables.write_json(summary, f"{out}/summary")
    return Analysis(
        usable, features, players, comparison, results[best_kind], methods, sweep, labelled, statistics, names, summary
    )
