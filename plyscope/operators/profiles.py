"""What clusters look like: statistics, names, centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plyscope.operators.density import NOISE
from plyscope.schema import STYLE_FEATURES, TIERS

KEY_FEATURES = 10

# Archetypes from the highest mean rating down; the last also serves
# every further cluster.
ARCHETYPES = (
    (
        "Time Scramblers",
        "Fast players who thrive under time pressure",
        ["Fast moves", "High time pressure comfort", "Highest skill level"],
    ),
    (
        "Positional Grinders",
        "Players who maintain active pieces in controlled positions",
        ["Active pieces", "Simpler positions", "Medium skill level"],
    ),
    (
        "Tactical Battlers",
        "Players who seek complex tactical positions",
        ["Complex positions", "Material imbalances", "Developing skills"],
    ),
)


def cluster_statistics(
    labelled: DataFrame, features: list[str], tiers: dict = TIERS, label: str = "cluster"
) -> DataFrame:
    """Size, share, mean rating and games, tier shares and means of the first ten features.

    Noise has no row but counts in the share's denominator.
    """
    total = labelled.agg(F.count(F.lit(1)).alias("n")).scalar()
    have = set(labelled.columns)

    def mean(column):
        return F.avg(column) if column in have else F.lit(None).cast("double")

    shares = []
    if "skill_tier" in have:
        known = F.count("skill_tier")
        shares = [
            (
                F.count(F.when(F.col("skill_tier") == t, 1))
                / F.when(known > 0, known).otherwise(F.lit(1))
                * 100.0
            ).alias(f"pct_{t.lower()}")
            for t in tiers
        ]
    stats = (
        labelled.where(F.col(label) != NOISE)
        .groupBy(F.col(label).alias("cluster"))
        .agg(
            F.count(F.lit(1)).alias("size"),
            mean("elo").alias("elo"),
            mean("game_count").alias("avg_games"),
            *shares,
            *[F.avg(c).alias(f"{c}_mean") for c in features[:KEY_FEATURES] if c in have],
        )
    )
    rest = [c for c in stats.columns if c not in ("cluster", "size")]
    return stats.select("cluster", "size", (F.col("size") / total * 100.0).alias("pct_of_total"), *rest)


def name_clusters(stats: DataFrame) -> DataFrame:
    """Archetype of every cluster by rank of mean rating, ties to the smaller cluster id.

    Only the leading ranks differ, so those few rows are taken by a top-k and the last
    archetype covers the rest without sorting them.
    """
    named = len(ARCHETYPES) - 1
    rating = F.coalesce("elo", F.lit(0.0))
    top = stats.orderBy(rating.desc(), "cluster").limit(named).select("cluster", rating.alias("_elo"))
    ranks = top.select(
        "cluster", F.row_number().over(Window.orderBy(F.desc("_elo"), "cluster")).alias("_rank")
    )

    def pick(i, default):
        chain = F.when(F.lit(False), default)
        for r, entry in enumerate(ARCHETYPES[:named], start=1):
            chain = chain.when(F.col("_rank") == r, _literal(entry[i]))
        return chain.otherwise(default)

    last = ARCHETYPES[-1]
    return stats.select("cluster", "size", rating.alias("elo")).join(
        F.broadcast(ranks), "cluster", "left"
    ).select(
        "cluster",
        pick(0, _literal(last[0])).alias("name"),
        pick(1, _literal(last[1])).alias("description"),
        pick(2, _literal(last[2])).alias("characteristics"),
        "size",
        "elo",
    )


def _literal(value):
    return F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)


def with_archetype(players: DataFrame, names: DataFrame) -> DataFrame:
    """Archetype name looked up by cluster id; a cluster without a name keeps NULL."""
    lookup = names.select("cluster", F.col("name").alias("archetype"))
    return players.join(lookup, "cluster", "left")


def archetype_centroids(players: DataFrame, features=STYLE_FEATURES) -> DataFrame:
    """Feature means per archetype in original units."""
    have = [c for c in features if c in players.columns]
    return players.where("archetype is not null").groupBy("archetype").agg(*[F.avg(c).alias(c) for c in have])


def archetype_sigma_profile(players: DataFrame, features=STYLE_FEATURES, group: str = "archetype") -> DataFrame:
    """Mean z-score (population) per archetype: the group mean, centred and scaled once."""
    have = [c for c in features if c in players.columns]
    overall = players.agg(
        *[F.avg(c).alias(f"m_{c}") for c in have], *[F.stddev_pop(c).alias(f"s_{c}") for c in have]
    )
    means = players.groupBy(group).agg(*[F.avg(c).alias(c) for c in have])
    return means.select(
        group,
        *[
            (
                (F.col(c) - overall.select(f"m_{c}").scalar())
                / F.nullif(overall.select(f"s_{c}").scalar(), F.lit(0.0))
            ).alias(c)
            for c in have
        ],
    )
