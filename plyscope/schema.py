"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

GAMES = T.StructType(
    [
        T.StructField("white_player", T.StringType()),
        T.StructField("black_player", T.StringType()),
        T.StructField("white_elo", T.IntegerType()),
        T.StructField("black_elo", T.IntegerType()),
        T.StructField("white_skill_tier", T.StringType()),
        T.StructField("black_skill_tier", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("time_control", T.StringType()),
        T.StructField("time_control_category", T.StringType()),
        T.StructField("base_time", T.IntegerType()),
        T.StructField("num_moves", T.IntegerType()),
        T.StructField("opening_eco", T.StringType()),
    ]
)

MOVE = T.StructType([T.StructField("move_san", T.StringType())])

GAMES_FULL = T.StructType(
    GAMES.fields
    + [
        T.StructField("opening_name", T.StringType()),
        T.StructField("moves", T.ArrayType(MOVE)),
        T.StructField("clock_times_white", T.ArrayType(T.DoubleType())),
        T.StructField("clock_times_black", T.ArrayType(T.DoubleType())),
    ]
)

# Rating tiers as half-open ranges [low, high), lowest tier first.
# Ratings outside every range take the last tier.
TIERS = {"Beginner": (0, 1400), "Intermediate": (1400, 1900), "Advanced": (1900, 4000)}
FOUR_TIERS = {
    "Beginner": (0, 1200),
    "Intermediate": (1200, 1600),
    "Advanced": (1600, 2000),
    "Expert": (2000, 4000),
}

# Full-move ranges of the game phases.
PHASE_MOVES = {"opening": (1, 10), "middlegame": (11, 25), "endgame": (26, 200)}
PHASES = tuple(PHASE_MOVES)

# Base seconds of the time controls. 600 belongs to rapid.
TIME_CONTROLS = {"bullet": (60, 120), "blitz": (180, 600), "rapid": (600, 1800)}

# Defaults of the analysis.
MIN_GAMES = 5
SEED = 42
TEST_SHARE = 0.15
VAL_SHARE = 0.15
K_RANGE = (2, 5)
DEFAULT_BASE_TIME = 300

CLOCK_FEATURES = (
    *(f"avg_time_{p}" for p in PHASES),
    *(f"time_variance_{p}" for p in PHASES),
    "low_time_move_ratio",
    "time_trouble_frequency",
)
PACE_FEATURES = tuple(f"time_per_complexity_{p}" for p in PHASES)
BOARD_FEATURES = ("avg_position_complexity", "material_imbalance_freq", "piece_activity_score")
OPENING_FEATURES = ("opening_aggression_score", "book_deviation_move")
GLOBAL_FEATURES = (*BOARD_FEATURES, *OPENING_FEATURES, "num_moves")
CONTROL_FLAGS = ("is_bullet", "is_blitz", "is_rapid")
STYLE_FEATURES = (
    *(f"avg_time_{p}" for p in PHASES),
    "low_time_move_ratio",
    "time_trouble_frequency",
    *GLOBAL_FEATURES,
)
PROFILE_IDS = ("player", "elo", "game_count", "skill_tier")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
