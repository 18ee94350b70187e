"""Sources, profiling and per-game features."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from plyscope.functions import board, openings
from plyscope.functions.clock import phase_slices, with_clock_features
from plyscope.functions.quality import MEASURES, centipawn_losses, with_move_quality
from plyscope.functions.tiers import base_seconds, time_control_category
from plyscope.operators import games as ops
from plyscope.operators import metrics, profiling, reports
from plyscope.plans.analysis import tier_phase_heatmap
from plyscope.schema import CLOCK_FEATURES, CONTROL_FLAGS, GAMES, GAMES_FULL, PHASES
from plyscope.session import scratch_path
from plyscope.sources import records, stages, tables
from verification import views
from verification.registry import query
from verification.tables import features, games, plies, points

SIDES = ("white", "black")
GAME_COLUMNS = [f.name for f in GAMES.fields]
GAME_INTS = "white_elo black_elo base_time num_moves"


def sans(df):
    return board.san_list(F.col("moves"))


def write_chunks(df, folder, stem):
    """Two chunk tables, as a loader would find them."""
    for i, even in enumerate((True, False)):
        part = df.where((F.col("game_id") % 2 == 0) == F.lit(even)).drop("game_id")
        part.write.parquet(f"{folder}/{stem}_{i}.parquet")


# --- sources and sinks ---------------------------------------------------------------


@query("S01_scan_game_chunks", f"SELECT {', '.join(GAME_COLUMNS)} FROM games", i=GAME_INTS)
def _(spark, sf):
    folder = scratch_path(spark, "chunks")
    write_chunks(games(spark, sf).select("game_id", *GAME_COLUMNS), folder, "games_processed_part")
    return tables.read_games(spark, folder)


@query(
    "S02_scan_full_game_chunks",
    """SELECT g.white_player, g.black_player, g.opening_name, g.base_time, p.* EXCLUDE (game_id) FROM games g JOIN (
         SELECT game_id, string_agg(san, ' ' ORDER BY ply) AS san_text, count(*) AS n_moves,
           count(*) FILTER (ply % 2 = 0) AS n_white_clocks, count(*) FILTER (ply % 2 = 1) AS n_black_clocks,
           sum(clock) FILTER (ply % 2 = 0) AS white_clock_sum
         FROM plies GROUP BY game_id) p USING (game_id)""",
    d="white_clock_sum",
    i="base_time n_moves n_white_clocks n_black_clocks",
)
def _(spark, sf):
    folder = scratch_path(spark, "chunks")
    columns = [f.name for f in GAMES_FULL.fields]
    write_chunks(games(spark, sf).select("game_id", *columns), folder, "games_full_part")
    full = tables.read_full_games(spark, folder)
    known = F.filter("clock_times_white", lambda c: c.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return full.select(
        "white_player",
        "black_player",
        "opening_name",
        "base_time",
        F.array_join(sans(full), " ").alias("san_text"),
        F.size("moves").alias("n_moves"),
        F.size("clock_times_white").alias("n_white_clocks"),
        F.size("clock_times_black").alias("n_black_clocks"),
        F.when(F.size(known) > 0, total).alias("white_clock_sum"),
    )


@query(
    "S05_games_with_clock_data",
    "SELECT DISTINCT game_id FROM plies WHERE ply % 2 = 1",
    i="game_id",
)
def _(spark, sf):
    return ops.with_clock_data(games(spark, sf), "clock_times_black").select("game_id")


_FEATURE_SLICE = "game_id, white_player, white_avg_time_opening, black_time_variance_endgame, book_deviation_move"
_SLICE_TYPES = {"d": "white_avg_time_opening black_time_variance_endgame", "i": "game_id book_deviation_move"}


@query("S06_stage_cache", f"SELECT {_FEATURE_SLICE} FROM feats", **_SLICE_TYPES)
def _(spark, sf):
    cache = stages.StageCache(spark, scratch_path(spark, "stages"))
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    cache.table("features", lambda: features(spark, sf), [lines], {"quality": False})

    def unused():
        raise AssertionError("a stored stage must not be rebuilt")

    return cache.table("features", unused, [lines], {"quality": False}).select(*_FEATURE_SLICE.split(", "))


@query("S07_parquet_sink", f"SELECT {_FEATURE_SLICE} FROM feats", **_SLICE_TYPES)
def _(spark, sf):
    path = scratch_path(spark, "features")
    tables.write_table(features(spark, sf), path, ["time_control_category"])
    return tables.read_features(spark, path).select(*_FEATURE_SLICE.split(", "))


_TIER_SCORES = """SELECT white_skill_tier AS actual, black_skill_tier AS predicted, count(*) AS n
  FROM games GROUP BY ALL"""


def tier_pairs(spark, sf):
    """White tier taken as the actual and black tier as the predicted label of a game."""
    return games(spark, sf).select(
        "game_id", F.col("white_skill_tier").alias("actual"), F.col("black_skill_tier").alias("predicted")
    )


@query("S08_json_sink", _TIER_SCORES, i="n")
def _(spark, sf):
    path = scratch_path(spark, "scores-json")
    tables.write_json(metrics.confusion_counts(tier_pairs(spark, sf)), path)
    return tables.read_json(spark, path, "actual string, predicted string, n bigint")


@query("S09_csv_sink", _TIER_SCORES, i="n")
def _(spark, sf):
    path = scratch_path(spark, "scores-csv")
    tables.write_csv(metrics.confusion_counts(tier_pairs(spark, sf)), path)
    return tables.read_csv(spark, path, "actual string, predicted string, n bigint")


@query(
    "S10_read_result_tables",
    "SELECT time_control_category, count(*) AS games, 'json' AS stored FROM games GROUP BY ALL"
    " UNION ALL SELECT time_control_category, count(*), 'csv' FROM games GROUP BY ALL",
    i="games",
)
def _(spark, sf):
    counts = profiling.games_per_control(games(spark, sf))
    json_path, csv_path = scratch_path(spark, "controls-json"), scratch_path(spark, "controls-csv")
    tables.write_json(counts, json_path)
    tables.write_csv(counts, csv_path)
    schema = "time_control_category string, games bigint"
    stored = tables.read_json(spark, json_path, schema).withColumn("stored", F.lit("json"))
    return stored.unionByName(
        tables.read_csv(spark, csv_path, schema).withColumn("stored", F.lit("csv"))
    )


@query(
    "S11_embedding_sink",
    "SELECT CAST(vec_id AS VARCHAR) AS player, x, y, cluster FROM points",
    d="x y",
    i="cluster",
)
def _(spark, sf):
    path = scratch_path(spark, "embedding")
    tables.write_embedding(
        points(spark, sf).withColumn("player", F.col("vec_id").cast("string")), path
    )
    return spark.read.parquet(path)


def record_text():
    """A game as record text, with every clock in whole seconds."""
    def header(name, value):
        return F.concat(F.lit(f'[{name} "'), value.cast("string"), F.lit('"]\n'))

    def step(move, i):
        clocks = F.when(i % 2 == 0, F.get("clock_times_white", F.floor(i / 2).cast("int"))).otherwise(
            F.get("clock_times_black", F.floor(i / 2).cast("int"))
        )
        number = (F.floor(i / 2) + 1).cast("string")
        dots = F.when(i % 2 == 0, ". ").otherwise("... ")
        shown = records.clock_text(F.coalesce(clocks, F.lit(0.0)))
        return F.concat(number, dots, move["move_san"], F.lit(" { [%clk "), shown, F.lit("] }"))

    text = F.array_join(F.transform("moves", step), " ")
    return F.concat(
        header("Event", F.lit("Rated game")),
        header("Site", F.col("game_id")),
        header("White", F.col("white_player")),
        header("Black", F.col("black_player")),
        header("Result", F.col("result")),
        header("WhiteElo", F.col("white_elo")),
        header("BlackElo", F.col("black_elo")),
        header("TimeControl", F.col("time_control")),
        header("ECO", F.col("opening_eco")),
        header("Opening", F.col("opening_name")),
        F.lit("\n"), text, F.lit(" "), F.col("result"), F.lit("\n"),
    )


@query(
    "S12_record_text_ingestion",
    """SELECT g.* EXCLUDE (game_id, w, g, b), p.* FROM games g JOIN (
         SELECT game_id, string_agg(san, ' ' ORDER BY ply) AS san_text,
           sum(floor(coalesce(clock, 0))) FILTER (ply % 2 = 0) AS white_seconds,
           coalesce(sum(floor(coalesce(clock, 0))) FILTER (ply % 2 = 1), 0) AS black_seconds
         FROM plies GROUP BY game_id) p USING (game_id)""".replace(" EXCLUDE (game_id, w, g, b)", " EXCLUDE (game_id)"),
    d="white_seconds black_seconds",
    i="game_id " + GAME_INTS,
)
def _(spark, sf):
    path = scratch_path(spark, "records")
    games(spark, sf).select(record_text().alias("value")).write.text(path)
    parsed = records.parse_records(records.read_records(spark, path), extra_tags=("Site",))

    def total(column):
        return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)

    return parsed.select(
        F.col("site").cast("bigint").alias("game_id"),
        *GAME_COLUMNS,
        "opening_name",
        F.array_join(sans(parsed), " ").alias("san_text"),
        total(F.col("clock_times_white")).alias("white_seconds"),
        total(F.col("clock_times_black")).alias("black_seconds"),
    )


@query(
    "S13_base_seconds",
    "SELECT time_control, CAST(split_part(time_control, '+', 1) AS BIGINT) AS base_seconds, count(*) AS games FROM games GROUP BY ALL",
    i="base_seconds games",
)
def _(spark, sf):
    return (
        games(spark, sf)
        .groupBy("time_control", base_seconds(F.col("time_control")).alias("base_seconds"))
        .agg(F.count(F.lit(1)).alias("games"))
    )


@query(
    "S14_time_control_category",
    """SELECT game_id, seconds, CASE WHEN seconds BETWEEN 60 AND 120 THEN 'bullet'
         WHEN seconds >= 180 AND seconds < 600 THEN 'blitz'
         WHEN seconds BETWEEN 600 AND 1800 THEN 'rapid' END AS category
       FROM (SELECT game_id, (base_time * (num_moves + 20)) % 2000 AS seconds FROM games)""",
    i="game_id seconds",
)
def _(spark, sf):
    seconds = (F.col("base_time") * (F.col("num_moves") + 20)) % 2000
    return (
        games(spark, sf)
        .select("game_id", seconds.alias("seconds"))
        .withColumn("category", time_control_category(F.col("seconds")))
    )


# --- profiling -----------------------------------------------------------------------


@query(
    "P01_dataset_stats",
    """SELECT count(*) AS total_games, count(DISTINCT white_player) AS unique_white_players,
         count(DISTINCT black_player) AS unique_black_players, min(white_elo) AS min_rating,
         max(white_elo) AS max_rating FROM games""",
    i="total_games unique_white_players unique_black_players min_rating max_rating",
)
def _(spark, sf):
    return profiling.dataset_stats(games(spark, sf))


@query(
    "P02_distinct_players",
    """SELECT (SELECT count(DISTINCT p) FROM (SELECT white_player AS p FROM games UNION ALL SELECT black_player FROM games)) AS distinct_players,
         count(DISTINCT white_player) + count(DISTINCT black_player) AS per_color_sum FROM games""",
    i="distinct_players per_color_sum",
)
def _(spark, sf):
    return profiling.distinct_players(games(spark, sf))


@query(
    "P03_games_per_control",
    "SELECT time_control_category, count(*) AS games FROM games GROUP BY ALL",
    i="games",
)
def _(spark, sf):
    return profiling.games_per_control(games(spark, sf))


# --- clock features ------------------------------------------------------------------


def by_side(df, columns):
    """(game, side) rows of per-colour columns."""
    rows = [
        F.struct(F.lit(s).alias("side"), *[F.col(f"{s}_{c}").alias(c) for c in columns]) for s in SIDES
    ]
    return df.select("game_id", F.explode(F.array(*rows)).alias("_r")).select("game_id", "_r.*")


_BOTH = "SELECT game_id, 'white' AS side, {w} FROM {t} UNION ALL SELECT game_id, 'black', {b} FROM {t}"


def both_sides_sql(columns, source="feats"):
    parts = {s: ", ".join(f"{s}_{c} AS {c}" for c in columns) for s in SIDES}
    return _BOTH.format(w=parts["white"], b=parts["black"], t=source)


def clock_query(name, columns):
    @query(name, both_sides_sql(columns), d=columns, i="game_id")
    def _(spark, sf):
        return by_side(with_clock_features(games(spark, sf)), columns)


@query(
    "F01_clock_guard",
    """SELECT r.game_id, CASE side WHEN 0 THEN 'white' ELSE 'black' END AS side, total >= 5 AND known > 0 AS usable
       FROM readings r""",
    i="game_id",
)
def _(spark, sf):
    df = with_clock_features(games(spark, sf))
    df = df.withColumns({f"{s}_usable": F.col(f"{s}_low_time_move_ratio").isNotNull() for s in SIDES})
    df = df.withColumn("black_total", F.size("clock_times_black"))
    return by_side(df, ["usable"]).join(
        df.select("game_id", "black_total"), "game_id"
    ).where("side = 'white' or black_total > 0").drop("black_total")


@query(
    "F02_time_spent",
    """SELECT s.game_id, CASE s.side WHEN 0 THEN 'white' ELSE 'black' END AS side, i, spent
       FROM spent s JOIN readings r USING (game_id, side) WHERE r.total >= 5""",
    d="spent",
    i="game_id i",
)
def _(spark, sf):
    df = by_side(with_clock_features(games(spark, sf), keep_spent=True), ["time_spent"])
    return df.select("game_id", "side", F.posexplode("time_spent").alias("p", "spent")).select(
        "game_id", "side", (F.col("p") + 1).alias("i"), "spent"
    )


@query(
    "F03_phase_slices",
    """SELECT s.game_id, CASE s.side WHEN 0 THEN 'white' ELSE 'black' END AS side,
         least(max(i), 5) AS n_opening, CASE WHEN max(i) > 12 THEN 7 ELSE 0 END AS n_middlegame,
         greatest(max(i) - 12, 0) AS n_endgame
       FROM spent s JOIN readings r USING (game_id, side) WHERE r.total >= 5 GROUP BY ALL""",
    i="game_id n_opening n_middlegame n_endgame",
)
def _(spark, sf):
    df = by_side(with_clock_features(games(spark, sf), keep_spent=True), ["time_spent"])
    df = df.where("time_spent is not null")
    return df.select(
        "game_id",
        "side",
        *[F.expr(f"coalesce(size({a}), 0)").alias(f"n_{p}") for p, a in phase_slices("time_spent").items()],
    )


clock_query("F04_phase_means", [f"avg_time_{p}" for p in PHASES])
clock_query("F05_phase_variances", [f"time_variance_{p}" for p in PHASES])
clock_query("F06_low_time_ratio", ["low_time_move_ratio"])
clock_query("F07_time_trouble", ["time_trouble_frequency"])


# --- move quality --------------------------------------------------------------------


@query(
    "F08_centipawn_loss",
    "SELECT game_id, ply, loss FROM losses WHERE loss IS NOT NULL",
    d="loss",
    i="game_id ply",
)
def _(spark, sf):
    losses = F.posexplode(centipawn_losses(F.col("evaluations"))).alias("p", "loss")
    return games(spark, sf).select("game_id", losses).select("game_id", (F.col("p") + 1).alias("ply"), "loss")


def quality_query(name, measure):
    @query(name, f"SELECT game_id, {measure} FROM quality", d=measure, i="game_id")
    def _(spark, sf):
        df = with_move_quality(games(spark, sf))
        return df.select("game_id", F.col(f"white_{measure}").alias(measure))


for _name, _measure in zip(
    ("F09_blunder_rate", "F10_mistake_rate", "F11_average_loss", "F12_accuracy"), MEASURES
):
    quality_query(_name, _measure)


@query(
    "F13_shared_quality",
    "SELECT game_id, 'white' AS side, * EXCLUDE (game_id) FROM quality UNION ALL SELECT game_id, 'black', * EXCLUDE (game_id) FROM quality",
    d=MEASURES,
    i="game_id",
)
def _(spark, sf):
    return by_side(with_move_quality(games(spark, sf)), MEASURES)


# --- complexity and openings ---------------------------------------------------------


@query(
    "F14_position_complexity",
    "SELECT game_id, avg_position_complexity FROM board",
    d="avg_position_complexity",
    i="game_id",
)
def _(spark, sf):
    df = games(spark, sf)
    return df.select("game_id", board.position_complexity(sans(df)).alias("avg_position_complexity"))


@query(
    "F15_material_imbalance",
    "SELECT game_id, material_imbalance_freq FROM standing",
    d="material_imbalance_freq",
    i="game_id",
)
def _(spark, sf):
    positions = plies(spark, sf).select("game_id", "white_material", "black_material", "n_legal_moves")
    return ops.position_features(positions).select("game_id", "material_imbalance_freq")


@query(
    "F15_material_from_piece_counts",
    """SELECT game_id, avg(CASE WHEN white_points <> black_points THEN 1 ELSE 0 END) AS material_imbalance_freq,
         avg(white_points) AS mean_white_points
       FROM (SELECT game_id, (white_material % 9) * 1 + 2 * 3 + 1 * 3 + 2 * 5 + (n_legal_moves % 2) * 9 AS white_points,
               (black_material % 9) * 1 + 2 * 3 + 1 * 3 + 2 * 5 + (ply % 2) * 9 AS black_points FROM plies)
       GROUP BY game_id""",
    d="material_imbalance_freq mean_white_points",
    i="game_id",
)
def _(spark, sf):
    two, one = F.lit(2), F.lit(1)
    counted = plies(spark, sf).withColumns(
        {
            "white_material": ops.material_points(F.col("white_material") % 9, two, one, two, F.col("n_legal_moves") % 2),
            "black_material": ops.material_points(F.col("black_material") % 9, two, one, two, F.col("ply") % 2),
        }
    )
    means = counted.groupBy("game_id").agg(F.avg("white_material").alias("mean_white_points"))
    return ops.position_features(counted).select("game_id", "material_imbalance_freq").join(means, "game_id")


@query(
    "F16_piece_activity",
    "SELECT game_id, piece_activity_score FROM standing",
    d="piece_activity_score",
    i="game_id",
)
def _(spark, sf):
    positions = plies(spark, sf).select("game_id", "white_material", "black_material", "n_legal_moves")
    return ops.position_features(positions).select("game_id", "piece_activity_score")


@query(
    "F17_board_stand_ins",
    "SELECT game_id, capture_share AS material_imbalance_freq, length_activity AS piece_activity_score FROM board",
    d="material_imbalance_freq piece_activity_score",
    i="game_id",
)
def _(spark, sf):
    return ops.with_board_features(games(spark, sf)).select(
        "game_id", "material_imbalance_freq", "piece_activity_score"
    )


def opening_query(name, column, expression, double=True):
    @query(name, f"SELECT game_id, {column} FROM opened", d=column if double else "", i="game_id" if double else f"game_id {column}")
    def _(spark, sf):
        df = games(spark, sf)
        return df.select("game_id", expression(df).alias(column))


opening_query("F18_letter_base", "letter_base", lambda df: openings.letter_base(F.col("opening_eco")))
opening_query("F19_subcode_shift", "subcode_shift", lambda df: openings.subcode_shift(F.col("opening_eco")))
opening_query("F20_early_tactics", "early_tactics", lambda df: openings.early_tactics(sans(df)), False)
opening_query(
    "F21_aggression_score",
    "opening_aggression_score",
    lambda df: openings.aggression_score(F.col("opening_eco"), sans(df)),
)
opening_query(
    "F22_book_deviation",
    "book_deviation_move",
    lambda df: openings.book_deviation(F.col("opening_eco"), F.col("opening_name")),
    False,
)


# --- assembly ------------------------------------------------------------------------


@query(
    "F23_absent_columns",
    """SELECT g.game_id, 'Unknown' AS white_player, '' AS opening_name, 0 AS num_moves, 0 AS is_blitz,
         8 + CASE WHEN length(opening_eco) >= 3 THEN coalesce(TRY_CAST(substr(opening_eco, 2) AS BIGINT) // 20, 0) ELSE 0 END AS book_deviation_move,
         c.time_trouble_frequency AS white_time_trouble_frequency
       FROM games g LEFT JOIN clocks_default c ON c.game_id = g.game_id AND c.side = 0""".replace(
        "clocks_default", f"(WITH {views.clock_views('_default', '300')} SELECT * FROM clocks_default)"
    ),
    d="white_time_trouble_frequency",
    i="game_id num_moves is_blitz book_deviation_move",
)
def _(spark, sf):
    absent = ("white_player", "opening_name", "num_moves", "time_control_category", "base_time")
    return ops.game_features(games(spark, sf).drop(*absent)).select(
        "game_id", "white_player", "opening_name", "num_moves", "is_blitz", "book_deviation_move",
        "white_time_trouble_frequency",
    )


@query("F24_control_flags", "SELECT game_id, is_bullet, is_blitz, is_rapid FROM feats", i="game_id is_bullet is_blitz is_rapid")
def _(spark, sf):
    df = games(spark, sf).withColumn("time_control_category", F.initcap("time_control_category"))
    return ops.with_control_flags(df).select("game_id", *CONTROL_FLAGS)


@query(
    "F25_color_asymmetry",
    """SELECT game_id, avg_time_opening_white_minus_black,
         0 * blunder_rate AS blunder_rate_white_minus_black, 0 * accuracy_percentage AS accuracy_white_minus_black FROM feats""",
    d="avg_time_opening_white_minus_black blunder_rate_white_minus_black accuracy_white_minus_black",
    i="game_id",
)
def _(spark, sf):
    df = ops.with_color_asymmetry(with_move_quality(with_clock_features(games(spark, sf))))
    return df.select(
        "game_id", "avg_time_opening_white_minus_black", "blunder_rate_white_minus_black", "accuracy_white_minus_black"
    )


_PACE = [f"time_per_complexity_{p}" for p in PHASES]


@query(
    "F26_time_per_complexity",
    f"SELECT game_id, {', '.join(f'white_{c}' for c in _PACE)} FROM feats",
    d=[f"white_{c}" for c in _PACE],
    i="game_id",
)
def _(spark, sf):
    return ops.game_features(games(spark, sf)).select("game_id", *[f"white_{c}" for c in _PACE])


@query("F26_time_per_complexity_both", both_sides_sql(_PACE), d=_PACE, i="game_id")
def _(spark, sf):
    return by_side(ops.game_features(games(spark, sf), white_only_pace=False), _PACE)


@query("F27_game_key", "SELECT game_id, white_player, black_player FROM feats", i="game_id")
def _(spark, sf):
    return ops.game_features(games(spark, sf)).select("game_id", "white_player", "black_player")


_TEXT = ["white_player", "black_player", "white_skill_tier", "black_skill_tier", "result", "time_control_category", "opening_eco", "opening_name"]
_INTS = ["game_id", "white_elo", "black_elo", "num_moves", *CONTROL_FLAGS, "book_deviation_move"]
_DOUBLES = [
    *[f"{s}_{c}" for s in SIDES for c in CLOCK_FEATURES],
    "avg_position_complexity", "material_imbalance_freq", "piece_activity_score", "opening_aggression_score",
    "avg_time_opening_white_minus_black",
    *[f"white_{c}" for c in _PACE],
]


@query("F28_game_features", f"SELECT {', '.join(_TEXT + _INTS + _DOUBLES)} FROM feats", d=_DOUBLES, i=_INTS)
def _(spark, sf):
    return features(spark, sf).select(*_TEXT, *_INTS, *_DOUBLES)


# --- flagship and game-level reports -------------------------------------------------


_TIERS = "(VALUES ('Beginner'), ('Intermediate'), ('Advanced')) AS v(tier)"


@query(
    "R01_tier_counts",
    f"""SELECT tier, (SELECT count(*) FROM games WHERE white_skill_tier = tier) AS white_games,
         (SELECT count(*) FROM games WHERE black_skill_tier = tier) AS black_games FROM {_TIERS}""",
    i="white_games black_games",
)
def _(spark, sf):
    return reports.tier_counts(games(spark, sf))


@query(
    "R02_tier_phase_time",
    f"""SELECT v.tier, avg(white_avg_time_opening) AS opening, avg(white_avg_time_middlegame) AS middlegame,
         avg(white_avg_time_endgame) AS endgame FROM {_TIERS} LEFT JOIN feats f ON f.white_skill_tier = v.tier GROUP BY v.tier""",
    d=PHASES,
)
def _(spark, sf):
    return tier_phase_heatmap(games(spark, sf), decimals=None)


@query(
    "R02_tier_phase_time_long",
    f"""SELECT tier, phase, seconds FROM (
         SELECT v.tier, avg(white_avg_time_opening) AS opening, avg(white_avg_time_middlegame) AS middlegame,
           avg(white_avg_time_endgame) AS endgame FROM {_TIERS} LEFT JOIN feats f ON f.white_skill_tier = v.tier GROUP BY v.tier)
       UNPIVOT (seconds FOR phase IN (opening, middlegame, endgame))""",
    d="seconds",
)
def _(spark, sf):
    wide = tier_phase_heatmap(games(spark, sf), decimals=None)
    return reports.long_form(wide, ["tier"], PHASES, "phase", "seconds")


@query(
    "R05_tier_move_quality",
    f"""SELECT v.tier, count(game_id) AS games, avg(blunder_rate) * 100 AS blunder_rate_pct, avg(accuracy_percentage) AS accuracy_pct
       FROM {_TIERS} LEFT JOIN feats f ON f.white_skill_tier = v.tier GROUP BY v.tier""",
    d="blunder_rate_pct accuracy_pct",
    i="games",
)
def _(spark, sf):
    return reports.tier_move_quality(with_move_quality(games(spark, sf)))


@query(
    "R25_opening_popularity",
    """SELECT white_skill_tier AS tier, opening_eco, count(*) AS games,
         avg(CASE WHEN result = '1-0' THEN 1 ELSE 0 END) AS win_rate FROM games GROUP BY ALL""",
    d="win_rate",
    i="games",
)
def _(spark, sf):
    return reports.opening_popularity(games(spark, sf))


@query(
    "R25_opening_edges",
    """SELECT tier, ply, source, target, count(*) AS games FROM (
         SELECT white_skill_tier AS tier, ply, lag(san) OVER (PARTITION BY game_id ORDER BY ply) AS source, san AS target
         FROM plies JOIN games USING (game_id) WHERE ply < 10) WHERE source IS NOT NULL GROUP BY ALL""",
    i="ply games",
)
def _(spark, sf):
    return reports.opening_edges(games(spark, sf))
