from __future__ import annotations

import math
import statistics

import pytest
from pyspark.sql import Window, functions as F

from plyscope.functions.clock import with_clock_features
from plyscope.operators.players import (
    balanced_players,
    fold_sides,
    player_aggregates,
    player_profiles,
    side_averaged_profiles,
)
from plyscope.operators.ranking import bucketed_row_number, md5_row_number
from plyscope.operators.ratios import classification_rows, color_feature_columns, with_ratios
from plyscope.operators.split import class_weights, dealt, stratified_split
from plyscope.sources import tpch_view

SCHEMA = (
    "game_id long, white_player string, black_player string, white_elo int, black_elo int, white_skill_tier string, "
    "black_skill_tier string, num_moves int, white_avg_time_opening double, black_avg_time_opening double, "
    "white_time_per_complexity_opening double"
)
ROWS = [
    (1, "ann", "bob", 1300, 1950, "Beginner", "Advanced", 10, 1.0, 5.0, 0.1),
    (2, "ann", "cat", 1320, 1500, "Beginner", "Intermediate", 20, 2.0, 6.0, 0.2),
    (3, "bob", "ann", 1990, 1340, "Advanced", "Beginner", 30, 3.0, 7.0, 0.3),
    (4, None, "cat", 1000, 1500, "Beginner", "Intermediate", 40, 4.0, None, 0.4),
    (5, "dan", "dan", 1450, 1450, "Intermediate", "Intermediate", 50, 8.0, 10.0, 0.5),
]


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_fold_reads_once(spark, features, tmp_path):
    path = str(tmp_path / "f")
    features.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = player_profiles(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert fold_sides(stored).count() == 2 * len(ROWS)


def test_aggregates(features):
    names = ["avg_time_opening", "time_per_complexity_opening", "num_moves"]
    rows = {r["player"]: r for r in player_aggregates(fold_sides(features), names).collect()}
    assert set(rows) == {"ann", "bob", "cat", "dan"}
    ann = rows["ann"]
    assert ann["game_count"] == 3 and ann["elo"] == pytest.approx(1320)
    assert ann["avg_time_opening_std"] == pytest.approx(statistics.stdev([1.0, 2.0, 7.0]))
    assert ann["time_per_complexity_opening"] == pytest.approx(0.15)
    # one white game: a single pace value has no spread; only black games: no pace at all
    assert rows["bob"]["time_per_complexity_opening_std"] == 0.0
    assert rows["cat"]["time_per_complexity_opening"] is None
    assert rows["cat"]["avg_time_opening"] == 6.0 and rows["cat"]["avg_time_opening_std"] == 0.0
    assert rows["dan"]["game_count"] == 2


def test_profiles_drop_incomplete(features):
    kept = {r["player"]: r["skill_tier"] for r in player_profiles(features, min_games=2).collect()}
    assert kept == {"ann": "Beginner", "bob": "Advanced", "dan": "Intermediate"}
    assert player_profiles(features, min_games=2, complete=False).count() == 4


def test_side_averages(features):
    rows = {r["player"]: r for r in side_averaged_profiles(features, 1).collect()}
    assert rows["ann"]["avg_time_opening"] == pytest.approx((1.5 + 7.0) / 2)
    # one black game has no sample std, so the pair has none
    assert rows["ann"]["avg_time_opening_std"] is None
    assert rows["ann"]["time_per_complexity_opening"] == pytest.approx(0.15)
    assert rows["cat"]["avg_time_opening"] == 6.0 and rows["cat"]["elo"] == 1500
    assert rows["bob"]["elo"] == 1990 and rows["bob"]["skill_tier"] == "Advanced"
    # two white games needed: ann keeps only the white side
    assert {r["player"] for r in side_averaged_profiles(features, 2).collect()} == {"ann", "cat"}


def test_balanced(features):
    assert [tuple(r) for r in balanced_players(features, 1).orderBy("player").collect()] == [
        ("ann", 2, 1), ("bob", 1, 1), ("dan", 1, 1),
    ]


def test_bucketed_rank_equals_plain(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") * 7919 % 4001).alias("v"),
        "id",
    )
    ranked = bucketed_row_number(df, ["k"], F.floor(F.col("v") / 100), [F.col("v"), F.col("id")], "r", "n")
    got = {row["id"]: (row["r"], row["n"]) for row in ranked.collect()}
    df.createOrReplaceTempView("plain")
    want = spark.sql(
        "select id, row_number() over (partition by k order by v, id) r, count(*) over (partition by k) n from plain"
    )
    assert got == {row["id"]: (row["r"], row["n"]) for row in want.collect()}


def test_md5_rank_is_a_permutation(spark):
    ranked = md5_row_number(spark.range(3000).withColumn("k", F.lit(1)), ["k"], [42, F.col("id")], "r")
    assert sorted(r["r"] for r in ranked.collect()) == list(range(1, 3001))


def test_lines_are_numbered_within_their_supplier(spark, sf):
    lines = tpch_view.table(spark, sf, "lineitem")
    plain = Window.partitionBy("l_suppkey").orderBy(*tpch_view.LINE_ORDER)
    want = lines.withColumn("rn", F.row_number().over(plain) - 1)
    got = tpch_view.numbered_lines(lines).select(*want.columns)
    assert want.exceptAll(got).isEmpty() and got.count() == want.count() == lines.count()


def test_split_shares(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("p"), F.col("id")).alias("player"),
        F.when(F.col("id") < 300, "a").when(F.col("id") < 330, "b").otherwise("c").alias("skill_tier"),
    )
    split = stratified_split(df)
    counts = {(r["skill_tier"], r["fold"]): r["count"] for r in split.groupBy("skill_tier", "fold").count().collect()}
    assert counts["a", "train"] == 210 and counts["a", "val"] == 45 and counts["a", "test"] == 45
    assert counts["b", "train"] == 21 and counts["b", "val"] + counts["b", "test"] == 9
    folds = {f: sum(n for (_, g), n in counts.items() if g == f) for f in ("train", "val", "test")}
    assert folds == {"train": 700, "val": 150, "test": 150}
    again = stratified_split(df.repartition(7))
    assert split.exceptAll(again).isEmpty()


def test_published_fold_sizes(spark):
    sizes = spark.createDataFrame([("I", 20_992), ("A", 11_957), ("B", 11_664)], "class string, n long")
    total = 20_992 + 11_957 + 11_664
    held = dealt(sizes.withColumn("part", F.lit(math.ceil(total * 0.3))), "n", "part", "held")
    got = dealt(held.withColumn("val_part", F.lit(6_692)), "held", "val_part", "val").collect()
    assert (total - sum(r["held"] for r in got), sum(r["val"] for r in got), sum(r["held"] - r["val"] for r in got)) == (31_229, 6_692, 6_692)


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "skill_tier string")
    got = {r["skill_tier"]: r["weight"] for r in class_weights(df).collect()}
    assert math.isclose(got["a"], 8 / 12) and math.isclose(got["b"], 2.0)


def test_complete_rows_are_looked_at_after_they_are_made(spark):
    """The features are worked out once; the filter reads them and holds none of their expressions."""
    games = spark.sql("""SELECT id AS game_id, id % 3 AS n, 300 AS base_time, if(id = 5, NULL, 'Beginner') AS black_skill_tier,
        transform(sequence(1, if(id = 3, 2, 16)), i -> if(id = 4 AND i = 2, double('NaN'), 300D - i * (id + 1))) AS clock_times_black,
        transform(sequence(1, 16), i -> 300D - i) AS clock_times_white FROM range(9)""")
    features = with_clock_features(games).withColumn("num_moves", F.when(F.col("game_id") != 6, 32))
    rows, columns = classification_rows(features, "black")
    filters = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "atleastnnonnulls" in line]
    assert len(filters) == 1 and "lambda" not in filters[0]
    wide = with_ratios(features, "black")
    assert columns == color_feature_columns(wide, "black") and rows.columns == ["game_id", "label", *columns]
    plain = wide.select("game_id", F.col("black_skill_tier").alias("label"), *columns).collect()
    whole = [tuple(r) for r in plain if all(v is not None and v == v for v in r)]
    assert sorted(tuple(r) for r in rows.collect()) == sorted(whole) and {r[0] for r in whole} == {0, 1, 2, 4, 7, 8}
