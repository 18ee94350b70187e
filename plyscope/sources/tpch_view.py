"""Game-shaped tables over the order-line test tables.

One line item is one ply, one supplier is one player, and forty consecutive line items
of a supplier make one game, so a game's arrays are bounded by construction. Numbering a
supplier's line items is the only wide step over all rows; each is numbered month by month, so
that no task sorts a whole supplier.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plyscope.operators.players import with_game_tiers
from plyscope.operators.ranking import bucketed_row_number

PLIES_PER_GAME = 40
GAME_STRIDE = 1_000_000_000

LINE_ORDER = (
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    "l_quantity", "l_tax", "l_discount", "l_returnflag", "l_linestatus",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Append ``rn``: 0-based position of a line within its supplier.

    Every supplier is numbered by month and shifted by the sizes of its earlier months.
    """
    month = F.coalesce(F.trunc("l_shipdate", "month"), F.lit("0001-01-01").cast("date"))
    numbered = bucketed_row_number(lines, ["l_suppkey"], month, [F.col(c) for c in LINE_ORDER], "rn")
    return numbered.withColumn("rn", F.col("rn") - 1)


def plies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ply with its clock reading, move string, evaluation and board counts."""
    lines = numbered_lines(table(spark, sf_dir, "lineitem"))
    players = table(spark, sf_dir, "supplier").select(F.count(F.lit(1)).alias("n"))
    # only what a ply is made from moves to its game; all else is worked out where the game meets
    shaped = lines.selectExpr(
        f"l_suppkey * {GAME_STRIDE} + rn DIV {PLIES_PER_GAME} AS game_id",
        "l_suppkey AS w",
        f"rn DIV {PLIES_PER_GAME} AS g",
        f"int(rn % {PLIES_PER_GAME}) AS ply",
        "bigint(l_quantity) AS q",
        "bigint(l_linenumber) AS ln",
        "floor(l_extendedprice) AS price",
        "l_tax > 0.075D AS hidden",
        "l_returnflag = 'A' AS takes",
        "l_linestatus = 'F' AS checks",
    ).selectExpr("*", f"q * {BASE_TIME} DIV 6 - if(ply % 8 < 2, 300, 0) AS cost")
    rows = shaped.select("*", F.expr(USED).alias("used"))
    return rows.select(
        *[
            F.expr(text)
            for text in (
                "game_id",
                "w",
                "g",
                "ply",
                f"{BASE_TIME} AS base_time",
                SAN + " AS san",
                "price % 600 - 300 AS eval_cp",
                "39 - q % 4 AS white_material",
                "39 - ln % 4 AS black_material",
                "10 + q % 35 AS n_legal_moves",
            )
        ],
        (F.expr("w * 7 + g * 13 + 1") % players.scalar()).alias("b"),
        F.expr(f"if(hidden, NULL, greatest(0, {BASE_TIME} * 100 - used) / 100D)").alias("clock"),
    )


BASE_TIME = "element_at(array(60, 180, 300, 600, 900), int(g % 5 + 1))"

SAN = """concat(
    element_at(array('', 'N', 'B', 'R', 'Q'), int(ln % 5 + 1)),
    if(takes, 'x', ''), char(97 + q % 8), string(1 + ln % 8),
    if(ln % 5 = 0 AND q % 11 = 0, '=Q', ''),
    CASE WHEN q = 50 THEN '#' WHEN checks AND q % 5 = 0 THEN '+' ELSE '' END)"""

# Running cost of this colour's moves in the game. Partitioned by the game alone (the other
# colour's cost counts as zero), so that the grouping into games needs no further shuffle.
_so_far = "OVER (PARTITION BY game_id ORDER BY ply ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
USED = f"if(ply % 2 = 0, sum(if(ply % 2 = 0, cost, 0)) {_so_far}, sum(if(ply % 2 = 1, cost, 0)) {_so_far})"


def in_ply_order(value: str, side: int | None = None) -> str:
    """A game's values as an array, all plies or one colour's."""
    entry = f"struct(ply, {value} AS v)"
    listed = entry if side is None else f"if(ply % 2 = {side}, {entry}, NULL)"
    return f"transform(sort_array(collect_list({listed})), e -> e.v)"


def _rating(player: str) -> str:
    return f"int(700 + ({player} * 371) % 1600 + (g * 11) % 120)"


def games_full(plies_df: DataFrame, measures: Sequence[Column] = ()) -> DataFrame:
    """One row per game with move list, clock arrays and evaluations; ``measures`` are further aggregates of its plies."""
    grouped = plies_df.groupBy("game_id").agg(
        *[
            F.expr(text)
            for text in (
                "first(w) AS w",
                "first(g) AS g",
                "first(b) AS b",
                "first(base_time) AS base_time",
                "int(count(*)) AS num_moves",
                f"transform({in_ply_order('san')}, s -> struct(s AS move_san)) AS moves",
                f"{in_ply_order('clock', 0)} AS clock_times_white",
                f"{in_ply_order('clock', 1)} AS clock_times_black",
                f"{in_ply_order('double(eval_cp)')} AS evaluations",
            )
        ],
        *measures,
    )
    letter = "char(65 + (w + g) % 5)"
    described = grouped.selectExpr(
        "game_id",
        "concat('p', lpad(string(w), 12, '0')) AS white_player",
        "concat('p', lpad(string(b), 12, '0')) AS black_player",
        f"{_rating('w')} AS white_elo",
        f"{_rating('b')} AS black_elo",
        "CASE WHEN (w + g) % 10 < 5 THEN '1-0' WHEN (w + g) % 10 < 6 THEN '1/2-1/2' ELSE '0-1' END AS result",
        "concat(string(base_time), if(g % 2 = 0, '+0', '+3')) AS time_control",
        "CASE WHEN base_time = 60 THEN 'bullet' WHEN base_time < 600 THEN 'blitz' ELSE 'rapid' END"
        " AS time_control_category",
        "base_time",
        "num_moves",
        f"""CASE WHEN g % 11 = 0 THEN '' WHEN g % 11 = 1 THEN {letter}
              WHEN g % 11 = 2 THEN concat({letter}, 'x1')
              ELSE concat({letter}, lpad(string((w * 3 + g * 7) % 100), 2, '0')) END AS opening_eco""",
        "if(g % 9 = 0, '', concat('Open', repeat(' line', int(g % 19)))) AS opening_name",
        "moves",
        "clock_times_white",
        "clock_times_black",
        "evaluations",
        *grouped.columns[grouped.columns.index("evaluations") + 1 :],
    )
    return with_game_tiers(described)


def positions(plies_df: DataFrame) -> DataFrame:
    """Board counts per ply."""
    return plies_df.select("game_id", "ply", "white_material", "black_material", "n_legal_moves")
