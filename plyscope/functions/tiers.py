"""Rating tiers and time controls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from plyscope.schema import TIERS, TIME_CONTROLS


def tier_of(rating: Column, tiers: dict = TIERS) -> Column:
    """First tier whose half-open range holds the rating, else the last tier."""
    *_, last = tiers
    chain = reduce(
        lambda acc, item: acc.when((rating >= item[1][0]) & (rating < item[1][1]), F.lit(item[0])),
        tiers.items(),
        F.when(F.lit(False), F.lit(last)),
    )
    return chain.otherwise(F.lit(last))


def tier_position(tier: Column, tiers: dict = TIERS) -> Column:
    """0-based position of a tier from weakest to strongest; NULL when unknown."""
    return F.nullif(F.array_position(F.array(*[F.lit(t) for t in tiers]), tier), F.lit(0)) - 1


def tier_code(tier: Column, tiers: dict = TIERS) -> Column:
    """0-based alphabetical code of a tier; NULL when unknown."""
    return tier_position(tier, dict.fromkeys(sorted(tiers)))


def base_seconds(time_control: Column) -> Column:
    """Base seconds of a ``base+increment`` string."""
    return F.split(time_control, r"\+")[0].try_cast("int")


def time_control_category(seconds: Column) -> Column:
    bullet, blitz, rapid = (TIME_CONTROLS[k] for k in ("bullet", "blitz", "rapid"))
    return (
        F.when(seconds.between(*bullet), "bullet")
        .when((seconds >= blitz[0]) & (seconds < blitz[1]), "blitz")
        .when(seconds.between(*rapid), "rapid")
    )


def control_flag(category: Column, name: str) -> Column:
    return F.coalesce((F.lower(category) == name).cast("int"), F.lit(0))
