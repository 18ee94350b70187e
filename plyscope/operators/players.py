"""Games folded to players, and players aggregated to profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plyscope.functions.tiers import tier_of
from plyscope.operators.ratios import complete_cases
from plyscope.schema import (
    GLOBAL_FEATURES,
    MIN_GAMES,
    TIERS,
    numeric_columns,
)

SIDES = ("white", "black")


def side_features(features: DataFrame, side: str) -> dict[str, str]:
    """Plain feature name -> column name for the numeric columns of one side."""
    ids = {f"{side}_player", f"{side}_skill_tier", f"{side}_elo"}
    return {
        c.removeprefix(f"{side}_"): c
        for c in numeric_columns(features)
        if c.startswith(f"{side}_") and c not in ids
    }


def folded_feature_names(features: DataFrame, shared=GLOBAL_FEATURES) -> list[str]:
    names = dict.fromkeys([*side_features(features, "white"), *side_features(features, "black")])
    return [*names, *[c for c in shared if c in features.columns]]


def fold_sides(features: DataFrame, shared=GLOBAL_FEATURES, extra=()) -> DataFrame:
    """Two rows per game, one per player, from a single read of the games.

    A feature that one side lacks is NULL there. ``extra`` carries columns unchanged.
    """
    maps = {s: side_features(features, s) for s in SIDES}
    names = list(dict.fromkeys([*maps["white"], *maps["black"]]))
    shared = [c for c in shared if c in features.columns]

    def record(side):
        own = [
            (F.col(maps[side][n]) if n in maps[side] else F.lit(None)).cast("double").alias(n)
            for n in names
        ]
        return F.struct(
            F.lit(side).alias("side"),
            F.col(f"{side}_player").alias("player"),
            F.col(f"{side}_elo").cast("double").alias("elo"),
            F.col(f"{side}_skill_tier").alias("game_tier"),
            *own,
        )

    rows = features.select(
        F.explode(F.array(record("white"), record("black"))).alias("_r"),
        *[F.col(c).cast("double").alias(c) for c in shared],
        *extra,
    )
    return rows.select("_r.*", *shared, *extra)


def player_aggregates(
    sides: DataFrame, features: list[str], with_std: bool = True
) -> DataFrame:
    """Mean, optional sample std (0 for a single value), mean rating and game count.

    One shuffle on the player; partial aggregates keep a hot player's rows off the wire.
    """
    stats = [F.avg(c).alias(c) for c in features]
    if with_std:
        stats += [
            F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"{c}_std") for c in features
        ]
    return (
        sides.where(F.col("player").isNotNull())
        .groupBy("player")
        .agg(F.avg("elo").alias("elo"), F.count(F.lit(1)).alias("game_count"), *stats)
    )


def profile_features(features: list[str], with_std: bool = True) -> list[str]:
    return [*features, *[f"{c}_std" for c in features if with_std]]


def player_profiles(
    game_features: DataFrame,
    min_games: int = MIN_GAMES,
    with_std: bool = True,
    shared=GLOBAL_FEATURES,
    tiers: dict = TIERS,
    complete: bool = True,
) -> DataFrame:
    """Player profiles with a tier from the mean rating.

    ``complete`` drops players with an unknown feature, such as players without a
    white game, whose pace features have no value.
    """
    names = folded_feature_names(game_features, shared)
    profiles = (
        player_aggregates(fold_sides(game_features, shared), names, with_std)
        .where(F.col("game_count") >= min_games)
        .withColumn("skill_tier", tier_of(F.col("elo"), tiers))
    )
    if complete:
        profiles = complete_cases(profiles, profile_features(names, with_std))
    return profiles


def side_averaged_profiles(game_features: DataFrame, min_games: int = MIN_GAMES) -> DataFrame:
    """Profiles that average the two sides' means instead of all games.

    A side counts only with ``min_games`` games on it. Rating and tier come from the
    white side when it counts; the tier is the most frequent one, ties to the smallest.
    A feature both sides have is NULL when either value is.
    """
    names = folded_feature_names(game_features)
    both = {*side_features(game_features, "white")} & {*side_features(game_features, "black")}
    both |= set(GLOBAL_FEATURES)
    white_only = {*side_features(game_features, "white")} - both
    per_side = (
        fold_sides(game_features)
        .where(F.col("player").isNotNull())
        .groupBy("player", "side")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("elo").alias("elo"),
            F.mode("game_tier", True).alias("skill_tier"),
            *[F.avg(c).alias(c) for c in names],
            *[F.stddev_samp(c).alias(f"{c}_std") for c in names],
        )
        .where(F.col("n") >= min_games)
    )

    def of(side, column):
        return F.max(F.when(F.col("side") == side, F.col(column)))

    values = profile_features(names)
    paired = per_side.groupBy("player").agg(
        *[of(s, "n").alias(f"_n_{s}") for s in SIDES],
        *[of(s, c).alias(f"_{c}_{s}") for c in ("elo", "skill_tier", *values) for s in SIDES],
    )
    has = {s: F.col(f"_n_{s}").isNotNull() for s in SIDES}

    def merged(column):
        white, black = F.col(f"_{column}_white"), F.col(f"_{column}_black")
        base = column.removesuffix("_std")
        if base in white_only:
            return F.when(has["white"], white).otherwise(black)
        mean = (white + black) / 2
        return F.when(has["white"] & has["black"], mean).when(has["white"], white).otherwise(black)

    def first_side(column):
        return F.when(has["white"], F.col(f"_{column}_white")).otherwise(F.col(f"_{column}_black"))

    return paired.select(
        "player",
        (F.coalesce("_n_white", F.lit(0)) + F.coalesce("_n_black", F.lit(0))).alias("game_count"),
        first_side("elo").alias("elo"),
        first_side("skill_tier").alias("skill_tier"),
        *[merged(c).alias(c) for c in values],
    )


def with_game_tiers(games: DataFrame, tiers: dict = TIERS) -> DataFrame:
    """Tier labels of both ratings of each game."""
    return games.withColumns(
        {f"{s}_skill_tier": tier_of(F.col(f"{s}_elo"), tiers) for s in SIDES}
    )


def balanced_players(games: DataFrame, per_side: int = 4) -> DataFrame:
    """Players with at least ``per_side`` games as white and as black."""
    seats = games.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(s).alias("side"), F.col(f"{s}_player").alias("player")) for s in SIDES]
            )
        ).alias("_s")
    ).select("_s.*")
    counts = seats.where("player is not null").groupBy("player").agg(
        *[F.count(F.when(F.col("side") == s, 1)).alias(f"{s}_games") for s in SIDES]
    )
    return counts.where((F.col("white_games") >= per_side) & (F.col("black_games") >= per_side))


def threshold_sweep(
    game_features: DataFrame, thresholds=(5, 10, 20), shared=GLOBAL_FEATURES
) -> DataFrame:
    """Samples and feature count per minimum game count and feature set.

    Players are aggregated once; every configuration is a conditional count over them.
    Standard deviations are never NULL, so a feature set changes only the width.
    """
    names = folded_feature_names(game_features, shared)
    players = player_aggregates(fold_sides(game_features, shared), names, with_std=False)
    known = F.lit(True)
    for c in names:
        known = known & F.col(c).isNotNull()
    counts = players.agg(
        *[F.count(F.when(known & (F.col("game_count") >= t), 1)).alias(f"s{t}") for t in thresholds]
    )
    width = len(names)
    sets = (("mean", width), ("mean_std", 2 * width), ("mean_std_count", 2 * width + 1))
    entries = [
        F.struct(
            F.lit(t).alias("min_games"),
            F.lit(label).alias("feature_set"),
            F.col(f"s{t}").alias("samples"),
            F.lit(n).alias("features"),
        )
        for t in thresholds
        for label, n in sets
    ]
    return counts.select(F.inline(F.array(*entries)))


def game_level_rows(
    game_features: DataFrame, both_sides: bool = False, shared=GLOBAL_FEATURES, tiers: dict = TIERS
) -> tuple[DataFrame, list[str]]:
    """Game-level model rows with the tier of that game's rating: white only, or both."""
    rows = fold_sides(game_features, shared, extra=["game_id"])
    names = folded_feature_names(game_features, shared)
    if not both_sides:
        rows = rows.where(F.col("side") == "white")
    rows = rows.withColumn("label", tier_of(F.col("elo"), tiers)).select(
        "game_id", "side", "player", "label", *names
    )
    return complete_cases(rows, names), names


def dashboard_profiles(profiles: DataFrame) -> DataFrame:
    """Consumer column names."""
    return profiles.withColumnsRenamed({"elo": "avg_elo", "game_count": "num_games"})

