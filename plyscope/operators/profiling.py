"""Counts that describe a game table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dataset_stats(games: DataFrame, approximate: bool = False) -> DataFrame:
    """Games, distinct players per colour, rating range; 0 for an absent column."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct

    def of(function, column):
        return function(column) if column in games.columns else F.lit(0)

    return games.agg(
        F.count(F.lit(1)).alias("total_games"),
        of(distinct, "white_player").alias("unique_white_players"),
        of(distinct, "black_player").alias("unique_black_players"),
        of(F.min, "white_elo").cast("int").alias("min_rating"),
        of(F.max, "white_elo").cast("int").alias("max_rating"),
    )


def distinct_players(games: DataFrame) -> DataFrame:
    """Players over both colours, and the per-colour sum that counts many twice."""
    seats = games.select(
        "white_player", "black_player", F.explode(F.array("white_player", "black_player")).alias("p")
    )
    return seats.agg(
        F.countDistinct("p").alias("distinct_players"),
        (F.countDistinct("white_player") + F.countDistinct("black_player")).alias("per_color_sum"),
    )


def games_per_control(games: DataFrame) -> DataFrame:
    return games.groupBy("time_control_category").agg(F.count(F.lit(1)).alias("games"))
