"""SQL views that mirror the game-shaped tables and features, written relationally."""

from __future__ import annotations

from plyscope.schema import CLOCK_FEATURES, GLOBAL_FEATURES, PACE_FEATURES, PHASES

TIER = "CASE WHEN {0} >= 0 AND {0} < 1400 THEN 'Beginner' WHEN {0} >= 1400 AND {0} < 1900 THEN 'Intermediate' ELSE 'Advanced' END"


def tier(expr: str) -> str:
    return TIER.format(f"({expr})")


_rating = "CAST(700 + ({0} * 371) % 1600 + (g * 11) % 120 AS BIGINT)"
_player = "'p' || lpad(CAST({0} AS VARCHAR), 12, '0')"

PLIES = f"""
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_suppkey
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity,
             l_tax, l_discount, l_returnflag, l_linestatus) - 1 AS rn
  FROM lineitem
),
shaped AS (
  SELECT l_suppkey AS w, rn // 40 AS g, rn % 40 AS ply,
         CAST(l_quantity AS BIGINT) AS q, CAST(l_linenumber AS BIGINT) AS ln,
         CAST(floor(l_extendedprice) AS BIGINT) AS price, l_tax > 0.075 AS hidden,
         l_returnflag AS flag, l_linestatus AS status
  FROM numbered
),
priced AS (
  SELECT *, CAST(CASE g % 5 WHEN 0 THEN 60 WHEN 1 THEN 180 WHEN 2 THEN 300 WHEN 3 THEN 600 ELSE 900 END AS BIGINT) AS base_time
  FROM shaped
),
running AS (
  SELECT *, CAST(sum((q * base_time) // 6 - CASE WHEN ply % 8 < 2 THEN 300 ELSE 0 END)
    OVER (PARTITION BY w, g, ply % 2 ORDER BY ply) AS BIGINT) AS used
  FROM priced
),
plies AS (
  SELECT w * 1000000000 + g AS game_id, w, g, ply, base_time,
    (w * 7 + g * 13 + 1) % (SELECT count(*) FROM supplier) AS b,
    CASE WHEN hidden THEN NULL ELSE CAST(greatest(0, base_time * 100 - used) AS DOUBLE) / CAST(100 AS DOUBLE) END AS clock,
    CASE ln % 5 WHEN 0 THEN '' WHEN 1 THEN 'N' WHEN 2 THEN 'B' WHEN 3 THEN 'R' ELSE 'Q' END
      || CASE WHEN flag = 'A' THEN 'x' ELSE '' END
      || chr(CAST(97 + q % 8 AS INTEGER)) || CAST(1 + ln % 8 AS VARCHAR)
      || CASE WHEN ln % 5 = 0 AND q % 11 = 0 THEN '=Q' ELSE '' END
      || CASE WHEN q = 50 THEN '#' WHEN status = 'F' AND q % 5 = 0 THEN '+' ELSE '' END AS san,
    price % 600 - 300 AS eval_cp,
    39 - q % 4 AS white_material, 39 - ln % 4 AS black_material, 10 + q % 35 AS n_legal_moves
  FROM running
)"""

GAMES = f"""
grouped AS (
  SELECT game_id, w, g, b, base_time, count(*) AS num_moves FROM plies GROUP BY ALL
),
games AS (
  SELECT game_id, {_player.format('w')} AS white_player, {_player.format('b')} AS black_player,
    {_rating.format('w')} AS white_elo, {_rating.format('b')} AS black_elo,
    {tier(_rating.format('w'))} AS white_skill_tier, {tier(_rating.format('b'))} AS black_skill_tier,
    CASE WHEN (w + g) % 10 < 5 THEN '1-0' WHEN (w + g) % 10 < 6 THEN '1/2-1/2' ELSE '0-1' END AS result,
    CAST(base_time AS VARCHAR) || CASE WHEN g % 2 = 0 THEN '+0' ELSE '+3' END AS time_control,
    CASE WHEN base_time = 60 THEN 'bullet' WHEN base_time < 600 THEN 'blitz' ELSE 'rapid' END AS time_control_category,
    base_time, num_moves,
    CASE WHEN g % 11 = 0 THEN ''
         WHEN g % 11 = 1 THEN chr(CAST(65 + (w + g) % 5 AS INTEGER))
         WHEN g % 11 = 2 THEN chr(CAST(65 + (w + g) % 5 AS INTEGER)) || 'x1'
         ELSE chr(CAST(65 + (w + g) % 5 AS INTEGER)) || lpad(CAST((w * 3 + g * 7) % 100 AS VARCHAR), 2, '0')
    END AS opening_eco,
    CASE WHEN g % 9 = 0 THEN '' ELSE 'Open' || repeat(' line', CAST(g % 19 AS INTEGER)) END AS opening_name
  FROM grouped
)"""


def clock_views(suffix: str = "", base: str = "base_time") -> str:
    """Time spent and the eight clock features per game and side (0 white, 1 black)."""
    return f"""
spent{suffix} AS (
  SELECT game_id, ply % 2 AS side, row_number() OVER s AS i,
         greatest(CAST(0 AS DOUBLE), coalesce(lag(clock) OVER s, {base}) - clock) AS spent
  FROM plies WHERE clock IS NOT NULL
  WINDOW s AS (PARTITION BY game_id, ply % 2 ORDER BY ply)
),
readings{suffix} AS (
  SELECT game_id, ply % 2 AS side, count(*) AS total, count(clock) AS known,
         count(*) FILTER (clock < 30) AS low_moves,
         count(*) FILTER (clock < {base} * CAST(0.1 AS DOUBLE)) AS trouble_moves
  FROM plies GROUP BY ALL
),
phases{suffix} AS (
  SELECT game_id, side, count(*) AS n,
    avg(spent) FILTER (i <= 5) AS m_opening,
    var_pop(spent) FILTER (i <= 5) AS v_opening,
    count(*) FILTER (i <= 5) AS n_opening,
    avg(spent) FILTER (i > 5 AND i <= 12) AS m_middlegame,
    var_pop(spent) FILTER (i > 5 AND i <= 12) AS v_middlegame,
    avg(spent) FILTER (i > 12) AS m_endgame,
    var_pop(spent) FILTER (i > 12) AS v_endgame
  FROM spent{suffix} GROUP BY ALL
),
clocks{suffix} AS (
  SELECT r.game_id, r.side, r.total, r.known, p.n_opening, p.n,
    CASE WHEN total >= 5 THEN m_opening END AS avg_time_opening,
    CASE WHEN total >= 5 AND n > 12 THEN m_middlegame END AS avg_time_middlegame,
    CASE WHEN total >= 5 AND n > 12 THEN m_endgame END AS avg_time_endgame,
    CASE WHEN total >= 5 AND n_opening > 1 THEN v_opening END AS time_variance_opening,
    CASE WHEN total >= 5 AND n > 12 THEN v_middlegame END AS time_variance_middlegame,
    CASE WHEN total >= 5 AND n - 12 > 1 THEN v_endgame END AS time_variance_endgame,
    CASE WHEN total >= 5 AND known > 0 THEN low_moves / total END AS low_time_move_ratio,
    CASE WHEN total >= 5 AND known > 0 THEN trouble_moves / total END AS time_trouble_frequency
  FROM readings{suffix} r LEFT JOIN phases{suffix} p USING (game_id, side)
)"""


QUALITY = """
losses AS (
  SELECT game_id, ply, abs(eval_cp - lag(eval_cp) OVER (PARTITION BY game_id ORDER BY ply)) AS loss
  FROM plies
),
quality AS (
  SELECT game_id,
    count(*) FILTER (loss > 200) / count(*) AS blunder_rate,
    count(*) FILTER (loss > 50 AND loss <= 200) / count(*) AS mistake_rate,
    coalesce(avg(loss), 0) AS avg_centipawn_loss,
    CASE WHEN count(loss) > 0 THEN greatest(CAST(0 AS DOUBLE), 100 - avg(loss) / 2) ELSE 50 END AS accuracy_percentage
  FROM losses GROUP BY game_id
)"""

BOARD = """
marks AS (
  SELECT game_id, ply,
    CASE WHEN contains(san, 'x') THEN 1 ELSE 0 END AS capture,
    CASE WHEN contains(san, '+') THEN 1 ELSE 0 END AS checked,
    CASE WHEN contains(san, '+') OR contains(san, '#') THEN 1 ELSE 0 END AS forcing,
    CASE WHEN contains(san, '=') THEN 1 ELSE 0 END AS promotion
  FROM plies
),
board AS (
  SELECT game_id,
    sum(capture + forcing + promotion) / count(*) * CAST(100 AS DOUBLE) AS avg_position_complexity,
    sum(capture) / count(*) AS capture_share,
    least(CAST(40 AS DOUBLE), CAST(20 AS DOUBLE) + count(*) * CAST(0.3 AS DOUBLE)) AS length_activity,
    sum(CASE WHEN ply < 10 THEN 2 * capture + 3 * checked ELSE 0 END) AS early_tactics
  FROM marks GROUP BY game_id
),
standing AS (
  SELECT game_id,
    avg(CASE WHEN white_material <> black_material THEN 1 ELSE 0 END) AS material_imbalance_freq,
    avg(n_legal_moves) AS piece_activity_score
  FROM plies GROUP BY game_id
)"""

OPENINGS = """
openings AS (
  SELECT g.game_id, opening_eco, opening_name,
    CASE substr(opening_eco, 1, 1) WHEN 'B' THEN 70 WHEN 'C' THEN 65 WHEN 'D' THEN 45 WHEN 'E' THEN 55 ELSE 50 END AS letter_base,
    coalesce(CASE
      WHEN length(opening_eco) >= 3 THEN (TRY_CAST(substr(opening_eco, 2, 2) AS BIGINT) - 50) * CAST(0.1 AS DOUBLE)
      WHEN length(opening_eco) = 2 THEN (TRY_CAST(substr(opening_eco, 2, 1) AS BIGINT) - 50) * CAST(0.1 AS DOUBLE)
    END, 0) AS subcode_shift,
    early_tactics,
    CASE WHEN length(opening_name) > 0
         THEN least(20, 5 + len(list_filter(string_split_regex(opening_name, '\\s+'), lambda x: x <> '')))
         ELSE 8 END AS named_depth,
    coalesce(CASE WHEN length(opening_eco) >= 3 THEN TRY_CAST(substr(opening_eco, 2) AS BIGINT) // 20 END, 0) AS code_depth
  FROM games g JOIN board USING (game_id)
),
opened AS (
  SELECT *,
    greatest(CAST(20 AS DOUBLE), least(CAST(100 AS DOUBLE), letter_base + subcode_shift + early_tactics)) AS opening_aggression_score,
    least(20, named_depth + code_depth) AS book_deviation_move
  FROM openings
)"""

_side_columns = ",\n    ".join(
    f"{alias}.{f} AS {color}_{f}"
    for color, alias in (("white", "cw"), ("black", "cb"))
    for f in CLOCK_FEATURES
)
_pace = ",\n    ".join(
    f"{color}_avg_time_{p} / (avg_position_complexity + CAST(0.001 AS DOUBLE)) AS {color}_time_per_complexity_{p}"
    for color in ("white", "black")
    for p in PHASES
)

FEATURES = f"""
joined AS (
  SELECT g.*, CASE WHEN time_control_category = 'bullet' THEN 1 ELSE 0 END AS is_bullet,
    CASE WHEN time_control_category = 'blitz' THEN 1 ELSE 0 END AS is_blitz,
    CASE WHEN time_control_category = 'rapid' THEN 1 ELSE 0 END AS is_rapid,
    {_side_columns},
    b.avg_position_complexity, s.material_imbalance_freq, s.piece_activity_score,
    o.opening_aggression_score, o.book_deviation_move,
    q.blunder_rate, q.mistake_rate, q.avg_centipawn_loss, q.accuracy_percentage
  FROM games g
  LEFT JOIN clocks cw ON cw.game_id = g.game_id AND cw.side = 0
  LEFT JOIN clocks cb ON cb.game_id = g.game_id AND cb.side = 1
  JOIN board b ON b.game_id = g.game_id
  JOIN standing s ON s.game_id = g.game_id
  JOIN opened o ON o.game_id = g.game_id
  JOIN quality q ON q.game_id = g.game_id
),
feats AS (
  SELECT *, white_avg_time_opening - black_avg_time_opening AS avg_time_opening_white_minus_black,
    {_pace}
  FROM joined
)"""

PROFILE_BASE = (*CLOCK_FEATURES, *PACE_FEATURES, *GLOBAL_FEATURES)
PROFILE_ALL = (*PROFILE_BASE, *(f"{c}_std" for c in PROFILE_BASE))


def _fold(color: str) -> str:
    own = [f"{color}_{f} AS {f}" for f in CLOCK_FEATURES]
    own += [
        f"{color}_{f} AS {f}" if color == "white" else f"CAST(NULL AS DOUBLE) AS {f}"
        for f in PACE_FEATURES
    ]
    shared = [f"CAST({f} AS DOUBLE) AS {f}" for f in GLOBAL_FEATURES]
    return (
        f"SELECT game_id, '{color}' AS side, {color}_player AS player, CAST({color}_elo AS DOUBLE) AS elo, "
        f"{color}_skill_tier AS game_tier, time_control_category, {', '.join(own + shared)}, is_bullet, is_blitz, is_rapid FROM feats"
    )


_means = ", ".join(f"avg({f}) AS {f}" for f in PROFILE_BASE)
_stds = ", ".join(f"coalesce(stddev_samp({f}), 0) AS {f}_std" for f in PROFILE_BASE)
_known = " AND ".join(f"{f} IS NOT NULL" for f in PROFILE_BASE)

PLAYERS = f"""
seats AS (
  {_fold('white')}
  UNION ALL
  {_fold('black')}
),
everyone AS (
  SELECT player, avg(elo) AS elo, count(*) AS game_count, {_means}, {_stds}
  FROM seats WHERE player IS NOT NULL GROUP BY player
),
players AS (
  SELECT *, {tier('elo')} AS skill_tier FROM everyone WHERE game_count >= 5 AND {_known}
),
labelled AS (
  SELECT *, CAST(substr(player, 2) AS BIGINT) % 4 - 1 AS cluster FROM players
)"""

POINTS = """
points AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
    CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS t, CAST(label AS BIGINT) AS cluster
  FROM embeddings
)"""

VIEWS = ",".join(
    [PLIES, GAMES, clock_views(), QUALITY, BOARD, OPENINGS, FEATURES, PLAYERS, POINTS]
).strip()
