"""Move, opening, quality and assembly rules on hand-made games."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plyscope.functions import board, openings
from plyscope.functions.quality import with_move_quality
from plyscope.functions.tiers import base_seconds, tier_code, tier_of, tier_position, time_control_category
from plyscope.operators.games import game_features, position_features, with_clock_data
from plyscope.operators.ratios import with_ratios
from plyscope.schema import FOUR_TIERS
from plyscope.sources import tpch_view
from plyscope.sources.tables import materialise, read_features
from verification import tables

MOVES = "array<struct<move_san:string>>"


def games(spark, rows):
    """Rows of (id, eco, name, list of move strings)."""
    data = [(i, e, n, None if m is None else [(s,) for s in m]) for i, e, n, m in rows]
    return spark.createDataFrame(data, f"game_id long, opening_eco string, opening_name string, moves {MOVES}")


def test_complexity_marks(spark):
    df = games(
        spark,
        [
            (0, "", "", None),
            (1, "", "", []),
            (2, "", "", ["exd8=Q+"]),
            (3, "", "", ["Qh7#", "e4", None, "Nxe5"]),
        ],
    )
    sans = board.san_list(F.col("moves"))
    got = df.select(
        "game_id", board.position_complexity(sans), board.capture_share(sans), board.length_activity(sans),
        openings.early_tactics(sans),
    ).collect()
    assert [tuple(r) for r in got] == [
        (0, None, None, None, 0),
        (1, None, None, None, 0),
        (2, 300.0, 1.0, 20.3, 5),
        (3, 50.0, 0.25, 21.2, 2),
    ]


@pytest.mark.parametrize(
    "eco, base, shift",
    [
        (None, 50, 0.0), ("", 50, 0.0), ("B", 70, 0.0), ("B9", 70, -4.1), ("B90", 70, 4.0),
        ("Bxx", 70, 0.0), ("Z10", 50, -4.0), ("C", 65, 0.0), ("D00", 45, -5.0), ("E60", 55, 1.0), ("A00", 50, -5.0),
    ],
)
def test_opening_code(spark, eco, base, shift):
    df = spark.createDataFrame([(eco,)], "eco string")
    row = df.select(openings.letter_base(F.col("eco")), openings.subcode_shift(F.col("eco"))).first()
    assert row[0] == base
    assert row[1] == pytest.approx(shift)


def test_aggression_limits(spark):
    df = games(spark, [(0, "B99", "", ["Qxe5+"] * 40), (1, "B00", "", ["e4"] * 10 + ["Nxe5+"] * 9)])
    got = df.select(openings.aggression_score(F.col("opening_eco"), board.san_list(F.col("moves")))).collect()
    assert [r[0] for r in got] == [100.0, pytest.approx(65.0)]


@pytest.mark.parametrize(
    "eco, name, depth",
    [
        ("", "", 8), ("B90", "", 12), ("B9", "", 8), ("Bxx", "Open", 6), ("B20", " ", 6),
        ("B99", " ".join(["w"] * 16), 20), ("", " ".join(["w"] * 16), 20), ("A05", " two words ", 7), ("B99", "one", 10),
    ],
)
def test_book_depth(spark, eco, name, depth):
    df = spark.createDataFrame([(eco, name)], "eco string, name string")
    assert df.select(openings.book_deviation(F.col("eco"), F.col("name"))).first()[0] == depth


def test_move_quality(spark):
    rows = [
        (0, None, ["e4"]),
        (1, [], ["e4"]),
        (2, [10.0], ["e4"]),
        (3, [0.0, 50.0, 101.0, 301.0, 100.0], ["a", "b", "c", "d", "e"]),
        (4, [0.0, 500.0], []),
    ]
    data = [(i, e, [(s,) for s in m]) for i, e, m in rows]
    df = with_move_quality(spark.createDataFrame(data, f"game_id long, evaluations array<double>, moves {MOVES}"))
    columns = [f"black_{c}" for c in ("blunder_rate", "mistake_rate", "avg_centipawn_loss", "accuracy_percentage")]
    got = {r["game_id"]: tuple(r[c] for c in columns) for r in df.collect()}
    assert got[0] == got[1] == (None,) * 4
    assert got[2] == (0.0, 0.0, 0.0, 50.0)
    # losses 50, 51, 200, 201: one blunder and two mistakes over five plies
    assert got[3] == pytest.approx((0.2, 0.4, 125.5, 37.25))
    assert got[4] == (0.0, 0.0, 500.0, 0.0)


def test_tier_limits(spark):
    ratings = [None, -1.0, 0.0, 1399.99, 1400.0, 1899.99, 1900.0, 3999.0, 4000.0]
    df = spark.createDataFrame([(r,) for r in ratings], "r double")
    assert [r[0] for r in df.select(tier_of(F.col("r"))).collect()] == [
        "Advanced", "Advanced", "Beginner", "Beginner", "Intermediate", "Intermediate", "Advanced", "Advanced", "Advanced",
    ]
    assert df.select(tier_of(F.col("r"), FOUR_TIERS)).collect()[0][0] == "Expert"
    tiers = spark.createDataFrame([("Beginner",), ("Intermediate",), ("Advanced",), ("?",)], "t string")
    got = tiers.select(tier_position(F.col("t")), tier_code(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(0, 1), (1, 2), (2, 0), (None, None)]


def test_time_controls(spark):
    df = spark.createDataFrame([("180+2",), ("600+0",), ("-",), (None,), ("150+0",), ("60+0",)], "tc string")
    got = df.select(base_seconds(F.col("tc")), time_control_category(base_seconds(F.col("tc")))).collect()
    assert [tuple(r) for r in got] == [
        (180, "blitz"), (600, "rapid"), (None, None), (None, None), (150, None), (60, "bullet"),
    ]


def test_positions_and_defaults(spark):
    positions = spark.createDataFrame(
        [(2, 0, 39, 39, 20), (2, 1, 39, 36, 30)],
        "game_id long, ply int, white_material int, black_material int, n_legal_moves int",
    )
    assert [tuple(r) for r in position_features(positions).collect()] == [(2, 0.5, 25.0)]
    df = games(spark, [(1, "B20", "Open", ["e4", "c5"]), (2, "", "", ["e4", "e5"])])
    got = {r["game_id"]: r for r in game_features(df, positions).collect()}
    assert (got[1]["material_imbalance_freq"], got[1]["piece_activity_score"]) == (0.0, 30.0)
    assert (got[2]["material_imbalance_freq"], got[2]["piece_activity_score"]) == (0.5, 25.0)
    assert got[1]["white_player"] == "Unknown" and got[1]["is_blitz"] == 0
    with pytest.raises(ValueError):
        game_features(df.drop("moves"))


def test_clock_filter(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [1.0])], "game_id long, clock_times_white array<double>")
    assert [r[0] for r in with_clock_data(df).select("game_id").collect()] == [3]


def test_ratio_of_zero_time(spark):
    columns = {f"white_avg_time_{p}": 0.0 for p in ("opening", "middlegame", "endgame")}
    row = with_ratios(spark.createDataFrame([columns])).first()
    assert row["white_time_opening_frac"] is None
    assert row["white_opening_vs_endgame_time_ratio"] == 0.0
    assert "white_time_variance_total" not in row.asDict()


def test_feature_stage_is_narrow_and_native(spark):
    """No shuffle and no Python in the game-feature projection; one scan."""
    path_schema = "game_id long, base_time int, opening_eco string, opening_name string, white_elo int, " \
        f"moves {MOVES}, clock_times_white array<double>, clock_times_black array<double>"
    df = spark.createDataFrame([], path_schema)
    plan = game_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_stage_cache_and_nan(spark, tmp_path):
    path = str(tmp_path / "stage")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, float("nan")), (2, 3.0)], "k int, v double")

    materialise(build, spark, path)
    materialise(build, spark, path)
    assert len(calls) == 1
    materialise(build, spark, path, force=True)
    assert len(calls) == 2
    assert read_features(spark, path).agg(F.avg("v")).first()[0] == 3.0


def test_feature_width(spark, sf):
    """40 game columns and 38 player columns, as published."""
    df = tables.features(spark, sf)
    assert len(df.columns) == 40
    assert len(tables.players(spark, sf).columns) == 38


def test_plies_are_numbered_once_for_games_and_positions(spark, tmp_path):
    """The measures that games carry are those of a table of positions, without a second pass over the plies."""
    rows = """SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 3 AS l_suppkey, int(id % 4) AS l_linenumber, double(1 + id * 7 % 50) AS l_quantity,
        double(id * 37 % 900) AS l_extendedprice, 0.05D AS l_discount, if(id % 11 = 0, NULL, id % 9 / 100D) AS l_tax,
        if(id % 5 = 0, NULL, if(id % 2 = 0, 'A', 'N')) AS l_returnflag, if(id % 3 = 0, 'F', 'O') AS l_linestatus,
        date_add(date '2020-01-01', int(id % 400)) AS l_shipdate FROM range(300)"""
    spark.sql(rows).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(3).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    carried = tables.features(spark, str(tmp_path))
    plies = tables.plies(spark, str(tmp_path))
    joined = game_features(tpch_view.games_full(plies), tpch_view.positions(plies))
    assert carried.columns == joined.columns and carried.count() == 9
    assert carried.exceptAll(joined).isEmpty() and joined.exceptAll(carried).isEmpty()
    plan = carried._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1
