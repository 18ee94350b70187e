"""Report-ready summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plyscope.schema import PHASES, TIERS

TIER_LIST = tuple(TIERS)


def tier_rows(spark, tiers=TIER_LIST) -> DataFrame:
    """The fixed tier list with its order."""
    return spark.range(1).select(
        F.posexplode(F.array(*[F.lit(t) for t in tiers])).alias("tier_order", "tier")
    )


def _all_tiers(summary: DataFrame, tiers=TIER_LIST) -> DataFrame:
    """Every tier of the fixed list, weakest first, also without rows of its own."""
    return (
        tier_rows(summary.sparkSession, tiers)
        .join(summary, "tier", "left")
        .orderBy("tier_order")
        .drop("tier_order")
    )


def tier_counts(games: DataFrame) -> DataFrame:
    """Games per tier of the white and of the black rating, from one pass."""
    seats = games.select(
        F.explode(
            F.array(
                F.struct(F.col("white_skill_tier").alias("tier"), F.lit(1).alias("w"), F.lit(0).alias("b")),
                F.struct(F.col("black_skill_tier").alias("tier"), F.lit(0).alias("w"), F.lit(1).alias("b")),
            )
        ).alias("_s")
    ).select("_s.*")
    counts = seats.groupBy("tier").agg(
        F.sum("w").alias("white_games"), F.sum("b").alias("black_games")
    )
    return _all_tiers(counts).na.fill(0, subset=["white_games", "black_games"])


def tier_phase_time(features: DataFrame, decimals: int | None = 2) -> DataFrame:
    """Mean seconds per move by tier and phase (white side), half-even rounding."""

    def shown(column):
        mean = F.avg(column)
        return mean if decimals is None else F.bround(mean, decimals)

    means = features.groupBy(F.col("white_skill_tier").alias("tier")).agg(
        *[shown(f"white_avg_time_{p}").alias(p) for p in PHASES]
    )
    return _all_tiers(means)


def long_form(table: DataFrame, ids: list[str], columns, name: str, value: str) -> DataFrame:
    return table.unpivot(ids, list(columns), name, value)


def tier_phase_variance(profiles: DataFrame) -> DataFrame:
    """Mean time variance by tier and phase, one row each."""
    means = profiles.groupBy(F.col("skill_tier").alias("tier")).agg(
        *[F.avg(f"time_variance_{p}").alias(p) for p in PHASES if f"time_variance_{p}" in profiles.columns]
    )
    return long_form(_all_tiers(means), ["tier"], means.columns[1:], "phase", "time_variance")


def tier_time_trouble(profiles: DataFrame) -> DataFrame:
    means = profiles.groupBy(F.col("skill_tier").alias("tier")).agg(
        (F.avg("time_trouble_frequency") * 100).alias("time_trouble_pct")
    )
    return _all_tiers(means)


def tier_move_quality(features: DataFrame) -> DataFrame:
    """Blunder rate (%) and accuracy by tier, for the measures that are present."""
    measures = {
        "blunder_rate_pct": ("white_blunder_rate", 100.0),
        "accuracy_pct": ("white_accuracy_percentage", 1.0),
    }
    present = [
        (F.avg(c) * scale).alias(name)
        for name, (c, scale) in measures.items()
        if c in features.columns
    ]
    means = features.groupBy(F.col("white_skill_tier").alias("tier")).agg(F.count(F.lit(1)).alias("games"), *present)
    return _all_tiers(means)


def key_figures(
    games: DataFrame, players: DataFrame, scores: DataFrame | None = None, clusters: DataFrame | None = None
) -> DataFrame:
    """One row of headline figures."""
    figures = {
        "total_games": games.agg(F.count(F.lit(1))).scalar(),
        "unique_players": players.agg(F.count(F.lit(1))).scalar(),
    }
    if scores is not None:
        figures["test_accuracy"] = scores.select("test_accuracy").scalar()
        figures["adjacent_accuracy"] = scores.select("adjacent_accuracy").scalar()
    if clusters is not None:
        figures["archetypes"] = clusters.agg(F.countDistinct("cluster")).scalar()
    return games.sparkSession.range(1).select(*[v.alias(k) for k, v in figures.items()])


def rating_histogram(players: DataFrame, column: str = "avg_elo", bins: int = 60) -> DataFrame:
    """Equal-width bins from the smallest to the largest rating; the maximum is in the last."""
    bounds = players.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    raw = F.when(low == high, F.lit(1)).otherwise(F.width_bucket(F.col(column), low, high, F.lit(bins)))
    return (
        players.where(F.col(column).isNotNull())
        .groupBy(F.least(F.lit(bins), raw).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("players"))
        .orderBy("bin")
    )


def archetype_shares(players: DataFrame, group: str = "archetype") -> DataFrame:
    counts = players.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("players"))
    total = players.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("players") / total)


def archetype_summary(players: DataFrame, group: str = "archetype", rating: str = "avg_elo") -> DataFrame:
    """Size, whole-percent share as text, and rounded mean rating."""
    placed = players.where(F.col(group).isNotNull())
    stats = placed.groupBy(group).agg(F.count("player").alias("size"), F.avg(rating).alias("_elo"))
    total = placed.agg(F.count("player")).scalar()
    return stats.select(
        group,
        "size",
        F.concat(F.bround(F.col("size") / total * 100.0, 0).cast("int").cast("string"), F.lit("%")).alias("pct"),
        F.bround("_elo", 0).cast("int").alias("avg_elo"),
    )


def filter_players(players: DataFrame, tiers, low: float, high: float, rating: str = "avg_elo") -> DataFrame:
    """Players on the map within a tier list and a closed rating range."""
    keep = F.col("skill_tier").isin(list(tiers)) & F.col(rating).between(low, high)
    if {"x", "y"} <= set(players.columns):
        keep = keep & F.col("x").isNotNull() & F.col("y").isNotNull()
    return players.where(keep)


def find_player(players: DataFrame, handle: str) -> DataFrame:
    """The first row with exactly this handle."""
    return players.where(F.col("player") == handle).limit(1)


def sample_players(players: DataFrame, group: str = "archetype") -> DataFrame:
    """One player per group: the one with the smallest md5, by a combinable minimum."""
    pick = F.min(F.struct(F.md5(F.col("player")).alias("digest"), "player"))
    return players.where(F.col(group).isNotNull()).groupBy(group).agg(pick.alias("_p")).select(group, "_p.player")


def top_importances(importances: DataFrame, n: int = 15) -> DataFrame:
    """Largest importances with a readable label."""
    text = F.regexp_replace(F.regexp_replace("feature", "white_", ""), "_", " ")
    return importances.orderBy(F.desc("importance"), "feature").limit(n).select(
        "feature", F.initcap(text).alias("label"), "importance"
    )


def tier_composition(stats: DataFrame, tiers=TIER_LIST) -> DataFrame:
    """Tier shares per cluster, one row each."""
    columns = [f"pct_{t.lower()}" for t in tiers if f"pct_{t.lower()}" in stats.columns]
    rows = long_form(stats.select("cluster", *columns), ["cluster"], columns, "_tier", "percentage")
    return rows.select("cluster", F.initcap(F.regexp_replace("_tier", "^pct_", "")).alias("tier"), "percentage")


def cluster_sizes(names: DataFrame) -> DataFrame:
    return names.select(F.col("name").alias("archetype"), "size", F.bround("elo", 0).cast("int").alias("avg_elo"))


def opening_popularity(games: DataFrame, side: str = "white") -> DataFrame:
    """Games and win rate of each opening by tier of one side."""
    won = "1-0" if side == "white" else "0-1"
    return games.groupBy(F.col(f"{side}_skill_tier").alias("tier"), "opening_eco").agg(
        F.count(F.lit(1)).alias("games"), F.avg((F.col("result") == won).cast("double")).alias("win_rate")
    )


def opening_edges(games: DataFrame, depth: int = 10, side: str = "white") -> DataFrame:
    """How often one move follows another within the first ``depth`` plies, by tier.

    Pairs are formed inside each game's own list; counts combine before the shuffle.
    """
    sans = F.slice(F.transform(F.col("moves"), lambda m: m["move_san"]), 1, depth)
    step = F.transform(
        F.sequence(F.lit(1), F.size("_s") - 1),
        lambda i: F.struct(
            i.alias("ply"),
            F.get(F.col("_s"), i - 1).alias("source"),
            F.get(F.col("_s"), i).alias("target"),
        ),
    )
    return (
        games.where(F.size("moves") > 1)
        .select(F.col(f"{side}_skill_tier").alias("tier"), sans.alias("_s"))
        .select("tier", F.explode(step).alias("e"))
        .groupBy("tier", "e.ply", "e.source", "e.target")
        .agg(F.count(F.lit(1)).alias("games"))
    )
