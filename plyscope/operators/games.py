"""One feature row per game: a single narrow projection unless positions are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plyscope.functions import board, openings
from plyscope.functions.clock import with_clock_features
from plyscope.functions.quality import with_move_quality
from plyscope.functions.tiers import control_flag
from plyscope.schema import CONTROL_FLAGS, DEFAULT_BASE_TIME, PHASES

COMPLEXITY_FLOOR = 1e-3
#: Prefix of position measures that the games carry already, so that their plies are read once.
CARRIED = "_positions_"


def with_default_columns(games: DataFrame) -> DataFrame:
    """Add absent columns with their defaults; NULLs inside present columns stay NULL."""
    unknown, empty = F.lit("Unknown"), F.lit("")
    defaults = {
        "white_player": unknown,
        "black_player": unknown,
        "white_elo": F.lit(None).cast("double"),
        "black_elo": F.lit(None).cast("double"),
        "white_skill_tier": unknown,
        "black_skill_tier": unknown,
        "num_moves": F.lit(0),
        "time_control_category": empty,
        "result": empty,
        "opening_eco": empty,
        "opening_name": empty,
        "base_time": F.lit(DEFAULT_BASE_TIME),
        "clock_times_white": F.lit(None).cast("array<double>"),
        "clock_times_black": F.lit(None).cast("array<double>"),
    }
    return games.withColumns({c: v for c, v in defaults.items() if c not in games.columns})


def with_clock_data(games: DataFrame, clocks: str = "clock_times_white") -> DataFrame:
    """Keep games whose clock list is present and not empty."""
    return games.where(F.col(clocks).isNotNull() & (F.size(clocks) > 0))


def with_control_flags(games: DataFrame) -> DataFrame:
    category = F.col("time_control_category")
    return games.withColumns({f: control_flag(category, f.removeprefix("is_")) for f in CONTROL_FLAGS})


def position_measures(prefix: str = "") -> list[Column]:
    """Aggregates of a game's positions: share with unequal material, and mean legal moves."""
    uneven = (F.col("white_material") != F.col("black_material")).cast("double")
    return [
        F.coalesce(F.avg(uneven), F.lit(0.0)).alias(f"{prefix}material_imbalance_freq"),
        F.coalesce(F.avg("n_legal_moves"), F.lit(board.IDLE_ACTIVITY)).alias(f"{prefix}piece_activity_score"),
    ]


def position_features(positions: DataFrame) -> DataFrame:
    """Per game: share of positions with unequal material, and mean legal moves."""
    return positions.groupBy("game_id").agg(*position_measures())


def material_points(pawns, knights, bishops, rooks, queens) -> Column:
    """Material of one side from its piece counts (fixed values 1, 3, 3, 5, 9)."""
    return pawns * 1 + knights * 3 + bishops * 3 + rooks * 5 + queens * 9


def with_board_features(games: DataFrame, positions: DataFrame | str | None = None) -> DataFrame:
    """Complexity from the moves; imbalance and activity from positions if given, a table or ``CARRIED``."""
    df = games.withColumn("_sans", board.san_list(F.col("moves")))
    sans = F.col("_sans")
    df = df.withColumn("avg_position_complexity", board.position_complexity(sans))
    if positions is None:
        return df.withColumns(
            {
                "material_imbalance_freq": board.capture_share(sans),
                "piece_activity_score": board.length_activity(sans),
            }
        )
    if isinstance(positions, DataFrame):
        measures = position_features(positions)
        renamed = measures.withColumnsRenamed({c: CARRIED + c for c in measures.columns if c != "game_id"})
        df = df.join(renamed, "game_id", "left")
    played = F.size(sans) > 0
    measured = {
        "material_imbalance_freq": F.when(played, F.coalesce(f"{CARRIED}material_imbalance_freq", F.lit(0.0))),
        "piece_activity_score": F.when(
            played, F.coalesce(f"{CARRIED}piece_activity_score", F.lit(board.IDLE_ACTIVITY))
        ),
    }
    return df.withColumns(measured).drop(*[CARRIED + c for c in measured])


def with_opening_features(games: DataFrame) -> DataFrame:
    """Aggression and book depth; needs the ``_sans`` helper of the board features."""
    eco, name = F.coalesce("opening_eco", F.lit("")), F.coalesce("opening_name", F.lit(""))
    return games.withColumns(
        {
            "opening_aggression_score": openings.aggression_score(eco, F.col("_sans")),
            "book_deviation_move": openings.book_deviation(eco, name),
        }
    )


def with_color_asymmetry(games: DataFrame) -> DataFrame:
    """White minus black for the measures both colours have."""
    pairs = {
        "avg_time_opening_white_minus_black": "avg_time_opening",
        "blunder_rate_white_minus_black": "blunder_rate",
        "accuracy_white_minus_black": "accuracy_percentage",
    }
    present = {
        name: F.col(f"white_{m}") - F.col(f"black_{m}")
        for name, m in pairs.items()
        if f"white_{m}" in games.columns and f"black_{m}" in games.columns
    }
    return games.withColumns(present) if present else games


def with_pace(games: DataFrame, white_only: bool = True) -> DataFrame:
    """Mean seconds per unit of complexity, per phase."""
    unit = F.col("avg_position_complexity") + COMPLEXITY_FLOOR
    return games.withColumns(
        {
            f"{c}_time_per_complexity_{p}": F.col(f"{c}_avg_time_{p}") / unit
            for c in (("white",) if white_only else ("white", "black"))
            for p in PHASES
        }
    )


def game_features(
    games_full: DataFrame,
    positions: DataFrame | str | None = None,
    white_only_pace: bool = True,
    evaluations: str | None = None,
) -> DataFrame:
    """All features of every game, one output row per input row.

    ``positions`` replaces the move-string stand-ins for imbalance and activity: a table, or ``CARRIED`` where the games
    were grouped with ``position_measures(CARRIED)``;
    ``evaluations`` names an array column and adds the move-quality measures.
    """
    if "moves" not in games_full.columns:
        raise ValueError("game features need the move list and clock arrays of each game")
    df = with_control_flags(with_default_columns(games_full))
    df = with_clock_features(df)
    if evaluations:
        df = with_move_quality(df, evaluations)
    df = with_opening_features(with_board_features(df, positions))
    df = with_pace(with_color_asymmetry(df), white_only_pace)
    return df.drop(
        "_sans", "moves", "clock_times_white", "clock_times_black", "evaluations",
        "base_time", "time_control",
    )
