"""Ratios, player profiles and player-level reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plyscope.functions.clock import with_clock_features
from plyscope.functions.quality import with_move_quality
from plyscope.functions.tiers import tier_of
from plyscope.operators import players as ops
from plyscope.operators import ratios, reports
from plyscope.operators.games import with_board_features
from plyscope.schema import CLOCK_FEATURES, CONTROL_FLAGS, FOUR_TIERS, GLOBAL_FEATURES, PACE_FEATURES, PHASES
from verification import tables
from verification.registry import query
from verification.tables import features, games
from verification.views import PROFILE_ALL, PROFILE_BASE, tier

ALL, BASE = list(PROFILE_ALL), list(PROFILE_BASE)
EPS = "CAST(0.001 AS DOUBLE)"


# --- engineered ratios ---------------------------------------------------------------


def ratio_query(name, columns, sql, build):
    @query(name, f"SELECT game_id, {sql} FROM feats", d=columns, i="game_id")
    def _(spark, sf):
        return ratios.with_ratios(build(games(spark, sf))).select("game_id", *columns)


_total = "nullif(white_avg_time_opening + white_avg_time_middlegame + white_avg_time_endgame, 0)"
ratio_query(
    "E01_phase_fractions",
    [f"white_time_{p}_frac" for p in PHASES],
    ", ".join(f"white_avg_time_{p} / {_total} AS white_time_{p}_frac" for p in PHASES),
    with_clock_features,
)
ratio_query(
    "E02_opening_endgame_ratio",
    ["white_opening_vs_endgame_time_ratio"],
    f"white_avg_time_opening / (white_avg_time_endgame + {EPS}) AS white_opening_vs_endgame_time_ratio",
    with_clock_features,
)
ratio_query(
    "E03_total_variance",
    ["white_time_variance_total"],
    "white_time_variance_opening + white_time_variance_middlegame + white_time_variance_endgame AS white_time_variance_total",
    with_clock_features,
)
ratio_query(
    "E04_low_time_to_trouble",
    ["white_low_time_to_trouble_ratio"],
    f"white_low_time_move_ratio / (white_time_trouble_frequency + {EPS}) AS white_low_time_to_trouble_ratio",
    with_clock_features,
)
ratio_query(
    "E05_errors_per_40_moves",
    ["white_blunders_per_40_moves", "white_mistakes_per_40_moves"],
    "blunder_rate * num_moves / 40 AS white_blunders_per_40_moves, mistake_rate * num_moves / 40 AS white_mistakes_per_40_moves",
    with_move_quality,
)
ratio_query(
    "E06_complexity_time_product",
    ["white_complexity_time_product"],
    "avg_position_complexity * white_avg_time_middlegame AS white_complexity_time_product",
    lambda g: with_board_features(with_clock_features(g)),
)


def _selected(color):
    own = [*CLOCK_FEATURES, *(PACE_FEATURES if color == "white" else ())]
    return [f"{color}_{c}" for c in own] + [*GLOBAL_FEATURES, *CONTROL_FLAGS]


@query(
    "E07_feature_selection",
    " UNION ALL ".join(
        f"SELECT '{c}' AS color, '{f}' AS feature, count({f}) AS known FROM feats" for c in ("white", "black") for f in _selected(c)
    ),
    i="known",
)
def _(spark, sf):
    df = features(spark, sf)
    rows = []
    counts = {}
    for color in ("white", "black"):
        for c in ratios.color_feature_columns(df, color):
            counts.setdefault(c, F.count(c).alias(c))
            rows.append((color, c))
    table = df.agg(*counts.values())
    entries = [F.struct(F.lit(a).alias("color"), F.lit(c).alias("feature"), F.col(c).alias("known")) for a, c in rows]
    return table.select(F.inline(F.array(*entries)))


_RATIOS = [
    *[f"time_{p}_frac" for p in PHASES], "opening_vs_endgame_time_ratio", "time_variance_total",
    "low_time_to_trouble_ratio", "complexity_time_product",
]


@query(
    "E08_complete_cases",
    f"""SELECT game_id, black_skill_tier AS label, black_avg_time_endgame, num_moves,
          black_avg_time_opening / nullif(black_avg_time_opening + black_avg_time_middlegame + black_avg_time_endgame, 0) AS black_time_opening_frac
        FROM feats WHERE {' AND '.join(f'black_{c} IS NOT NULL' for c in CLOCK_FEATURES)}
          AND black_avg_time_opening + black_avg_time_middlegame + black_avg_time_endgame <> 0""",
    d="black_avg_time_endgame black_time_opening_frac",
    i="game_id num_moves",
)
def _(spark, sf):
    rows, columns = ratios.classification_rows(features(spark, sf), "black")
    missing = {f"black_{c}" for c in _RATIOS} - set(columns)
    if missing:
        raise AssertionError(missing)
    return rows.select("game_id", "label", "black_avg_time_endgame", "num_moves", "black_time_opening_frac")


# --- folding and aggregation ---------------------------------------------------------


@query(
    "A01_color_fold",
    f"SELECT game_id, side, player, elo, {', '.join(BASE)} FROM seats",
    d=["elo", *BASE],
    i="game_id",
)
def _(spark, sf):
    return ops.fold_sides(features(spark, sf), extra=["game_id"]).select("game_id", "side", "player", "elo", *BASE)


def aggregates(spark, sf, **options):
    df = features(spark, sf)
    return ops.player_aggregates(ops.fold_sides(df), ops.folded_feature_names(df), **options)


@query(
    "A02_player_mean_std",
    f"SELECT player, elo, game_count, {', '.join(ALL)} FROM everyone",
    d=["elo", *ALL],
    i="game_count",
)
def _(spark, sf):
    return aggregates(spark, sf).select("player", "elo", "game_count", *ALL)


@query("A03_player_mean", f"SELECT player, elo, {', '.join(BASE)} FROM everyone", d=["elo", *BASE])
def _(spark, sf):
    return aggregates(spark, sf, with_std=False).select("player", "elo", *BASE)


@query(
    "A04_single_value_std",
    f"SELECT player || '/' || game_id AS player, {', '.join(f'0 AS {c}_std' for c in BASE)} FROM seats",
    d=[f"{c}_std" for c in BASE],
)
def _(spark, sf):
    df = features(spark, sf)
    single = ops.fold_sides(df, extra=["game_id"]).withColumn("player", F.concat_ws("/", "player", "game_id"))
    # one game per group, except that a player facing itself has two rows of one game
    own = single.withColumn("player", F.when(F.col("side") == "white", F.concat("player", F.lit("#w"))).otherwise(F.concat("player", F.lit("#b"))))
    std = ops.player_aggregates(own, ops.folded_feature_names(df))
    return std.select(F.regexp_replace("player", "#[wb]$", "").alias("player"), *[f"{c}_std" for c in BASE])


@query("A05_game_count", "SELECT player, game_count FROM everyone", i="game_count")
def _(spark, sf):
    return aggregates(spark, sf, with_std=False).select("player", "game_count")


@query(
    "A06_minimum_games",
    "SELECT player, game_count FROM everyone WHERE game_count >= 31",
    i="game_count",
)
def _(spark, sf):
    return ops.player_profiles(features(spark, sf), min_games=31, complete=False).select("player", "game_count")


_ODD_RATING = "CASE WHEN num_moves % 7 = 0 THEN NULL ELSE (white_elo * 37) % 5000 - 500 END"


@query(
    "A07_tier_of_rating",
    f"SELECT game_id, rating, {tier('rating')} AS tier FROM (SELECT game_id, {_ODD_RATING} AS rating FROM games)",
    i="game_id rating",
)
def _(spark, sf):
    rating = F.when(F.col("num_moves") % 7 != 0, (F.col("white_elo") * 37) % 5000 - 500)
    return games(spark, sf).select("game_id", rating.alias("rating")).withColumn("tier", tier_of(F.col("rating")))


@query(
    "A08_game_tiers",
    "SELECT game_id, white_skill_tier, black_skill_tier FROM games",
    i="game_id",
)
def _(spark, sf):
    bare = games(spark, sf).drop("white_skill_tier", "black_skill_tier")
    return ops.with_game_tiers(bare).select("game_id", "white_skill_tier", "black_skill_tier")


@query(
    "A09_player_profiles",
    f"SELECT player, elo, game_count, skill_tier, {', '.join(ALL)} FROM players",
    d=["elo", *ALL],
    i="game_count",
)
def _(spark, sf):
    return tables.players(spark, sf).select("player", "elo", "game_count", "skill_tier", *ALL)


_A10_MIN = 14


def _a10_column(c, std):
    name = f"{c}_std" if std else c
    if c in PACE_FEATURES:
        return f"CASE WHEN w.player IS NOT NULL THEN w.{name} END AS {name}"
    return (
        f"CASE WHEN w.player IS NOT NULL AND b.player IS NOT NULL THEN (w.{name} + b.{name}) / 2 "
        f"WHEN w.player IS NOT NULL THEN w.{name} ELSE b.{name} END AS {name}"
    )


_a10_side = (
    "SELECT player, side, count(*) AS n, avg(elo) AS elo, "
    + ", ".join(f"avg({c}) AS {c}, stddev_samp({c}) AS {c}_std" for c in BASE)
    + f" FROM seats WHERE player IS NOT NULL GROUP BY player, side HAVING count(*) >= {_A10_MIN}"
)


@query(
    "A10_side_averaged_profiles",
    f"""WITH tallies AS (SELECT player, side, game_tier, count(*) AS n FROM seats GROUP BY ALL),
          modes AS (SELECT player, side, game_tier FROM tallies
            QUALIFY row_number() OVER (PARTITION BY player, side ORDER BY n DESC, game_tier) = 1),
          sided AS (SELECT a.*, m.game_tier FROM ({_a10_side}) a JOIN modes m USING (player, side)),
          w AS (SELECT * FROM sided WHERE side = 'white'), b AS (SELECT * FROM sided WHERE side = 'black')
        SELECT coalesce(w.player, b.player) AS player, coalesce(w.n, 0) + coalesce(b.n, 0) AS game_count,
          CASE WHEN w.player IS NOT NULL THEN w.elo ELSE b.elo END AS elo,
          CASE WHEN w.player IS NOT NULL THEN w.game_tier ELSE b.game_tier END AS skill_tier,
          {', '.join(_a10_column(c, s) for s in (False, True) for c in BASE)}
        FROM w FULL OUTER JOIN b ON w.player = b.player""",
    d=["elo", *ALL],
    i="game_count",
)
def _(spark, sf):
    return ops.side_averaged_profiles(features(spark, sf), _A10_MIN).select(
        "player", "game_count", "elo", "skill_tier", *ALL
    )


@query(
    "A11_four_tiers",
    """SELECT CASE WHEN elo >= 0 AND elo < 1200 THEN 'Beginner' WHEN elo >= 1200 AND elo < 1600 THEN 'Intermediate'
         WHEN elo >= 1600 AND elo < 2000 THEN 'Advanced' ELSE 'Expert' END AS skill_tier, count(*) AS players
       FROM everyone WHERE game_count >= 5 GROUP BY 1""",
    i="players",
)
def _(spark, sf):
    profiles = ops.player_profiles(features(spark, sf), tiers=FOUR_TIERS, with_std=False, complete=False)
    return profiles.groupBy("skill_tier").agg(F.count(F.lit(1)).alias("players"))


_WIDE = [*BASE, *CONTROL_FLAGS]
_known = " AND ".join(f"{c} IS NOT NULL" for c in BASE)


@query(
    "A12_threshold_sweep",
    f"""SELECT min_games, feature_set, (SELECT count(*) FROM everyone WHERE game_count >= min_games AND {_known}) AS samples,
          features FROM (VALUES (25), (30), (33)) AS t(min_games),
          (VALUES ('mean', {len(_WIDE)}), ('mean_std', {2 * len(_WIDE)}), ('mean_std_count', {2 * len(_WIDE) + 1})) AS f(feature_set, features)""",
    i="min_games samples features",
)
def _(spark, sf):
    return ops.threshold_sweep(features(spark, sf), (25, 30, 33), (*GLOBAL_FEATURES, *CONTROL_FLAGS))


@query(
    "A13_balanced_players",
    """SELECT player, count(*) FILTER (side = 'white') AS white_games, count(*) FILTER (side = 'black') AS black_games
       FROM seats GROUP BY player HAVING count(*) FILTER (side = 'white') >= 15 AND count(*) FILTER (side = 'black') >= 15""",
    i="white_games black_games",
)
def _(spark, sf):
    return ops.balanced_players(games(spark, sf), 15)


# --- player-level reports ------------------------------------------------------------


_TIERS = "(VALUES ('Beginner'), ('Intermediate'), ('Advanced')) AS v(tier)"


@query(
    "R03_tier_phase_variance",
    f"""SELECT tier, phase, time_variance FROM (
          SELECT v.tier, {', '.join(f'avg(time_variance_{p}) AS {p}' for p in PHASES)}
          FROM {_TIERS} LEFT JOIN players p ON p.skill_tier = v.tier GROUP BY v.tier)
        UNPIVOT INCLUDE NULLS (time_variance FOR phase IN (opening, middlegame, endgame))""",
    d="time_variance",
)
def _(spark, sf):
    return reports.tier_phase_variance(tables.players(spark, sf))


@query(
    "R04_tier_time_trouble",
    f"""SELECT v.tier, avg(time_trouble_frequency) * 100 AS time_trouble_pct
        FROM {_TIERS} LEFT JOIN players p ON p.skill_tier = v.tier GROUP BY v.tier""",
    d="time_trouble_pct",
)
def _(spark, sf):
    return reports.tier_time_trouble(tables.players(spark, sf))


@query(
    "R06_key_figures",
    """SELECT (SELECT count(*) FROM games) AS total_games, (SELECT count(*) FROM players) AS unique_players,
         (SELECT avg(CASE WHEN white_skill_tier = black_skill_tier THEN 1 ELSE 0 END) FROM games) AS test_accuracy,
         (SELECT avg(CASE WHEN (white_skill_tier = 'Beginner') = (black_skill_tier = 'Advanced') AND (white_skill_tier = 'Advanced') = (black_skill_tier = 'Beginner')
            AND white_skill_tier IN ('Beginner', 'Advanced') THEN 0 ELSE 1 END) FROM games) AS adjacent_accuracy,
         (SELECT count(DISTINCT cluster) FROM labelled WHERE cluster >= 0) AS archetypes""",
    d="test_accuracy adjacent_accuracy",
    i="total_games unique_players archetypes",
)
def _(spark, sf):
    from plyscope.operators.metrics import score_row

    g = games(spark, sf)
    scores = score_row(g, "white_skill_tier", "black_skill_tier").withColumnRenamed("accuracy", "test_accuracy")
    placed = tables.labelled(spark, sf)
    return reports.key_figures(g, placed, scores, placed.where("cluster >= 0"))


@query(
    "R08_rating_histogram",
    """SELECT CASE WHEN hi = lo THEN 1 ELSE least(60, CAST(floor(60 * (elo - lo) / (hi - lo)) AS BIGINT) + 1) END AS bin, count(*) AS players
       FROM players, (SELECT min(elo) AS lo, max(elo) AS hi FROM players) GROUP BY 1""",
    i="bin players",
)
def _(spark, sf):
    return reports.rating_histogram(ops.dashboard_profiles(tables.stored_players(spark, sf)))


@query(
    "R12_player_drill_down",
    "SELECT player, elo AS avg_elo, skill_tier, game_count AS num_games FROM players WHERE player = 'p000000000007'",
    d="avg_elo",
    i="num_games",
)
def _(spark, sf):
    found = reports.find_player(ops.dashboard_profiles(tables.players(spark, sf)), "p000000000007")
    return found.select("player", "avg_elo", "skill_tier", "num_games")


@query(
    "R22_consumer_names",
    "SELECT player, elo AS avg_elo, game_count AS num_games, skill_tier FROM players",
    d="avg_elo",
    i="num_games",
)
def _(spark, sf):
    return ops.dashboard_profiles(tables.players(spark, sf)).select("player", "avg_elo", "num_games", "skill_tier")
