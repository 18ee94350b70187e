"""Clock features of one colour, from the array of remaining seconds after each move.

Each step is its own projection: later steps refer to earlier columns by name, so an
array is built once per row and not once per feature that reads it. The expressions are
SQL text, which keeps building the plan cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plyscope.schema import PHASE_MOVES, PHASES

MIN_CLOCKS = 5
LOW_SECONDS = 30
TROUBLE_SHARE = 0.1
# Phase limits count both colours' moves; one colour's list is cut at half of them.
OPENING_CUT = PHASE_MOVES["opening"][1] // 2
MIDDLE_CUT = PHASE_MOVES["middlegame"][1] // 2


def known_clocks(clocks: str, base: str) -> str:
    """Readings that are not NULL or NaN; NULL below five readings or without a base time."""
    return (
        f"CASE WHEN size({clocks}) >= {MIN_CLOCKS} AND {base} IS NOT NULL"
        f" THEN filter({clocks}, t -> t IS NOT NULL AND NOT isnan(t)) END"
    )


def seconds_spent(known: str, base: str) -> str:
    """Per move: previous reading minus this one, never below zero (increments clip)."""
    step = f"greatest(0D, coalesce(get({known}, i - 1), {base}) - t)"
    return f"CASE WHEN size({known}) > 0 THEN transform({known}, (t, i) -> {step}) END"


def phase_slices(spent: str) -> dict[str, str]:
    """Opening is always the head; the other two exist only past the middlegame cut."""
    long_enough = f"CASE WHEN size({spent}) > {MIDDLE_CUT} THEN"
    return {
        "opening": f"slice({spent}, 1, {OPENING_CUT})",
        "middlegame": f"{long_enough} slice({spent}, {OPENING_CUT + 1}, {MIDDLE_CUT - OPENING_CUT}) END",
        "endgame": f"{long_enough} slice({spent}, {MIDDLE_CUT + 1}, size({spent})) END",
    }


def mean_of(values: str) -> str:
    return f"CASE WHEN size({values}) > 0 THEN aggregate({values}, 0D, (s, x) -> s + x) / size({values}) END"


def variance_of(values: str, mean: str) -> str:
    """Population variance; NULL below two values."""
    squares = f"aggregate({values}, 0D, (s, x) -> s + (x - {mean}) * (x - {mean}))"
    return f"CASE WHEN size({values}) > 1 THEN {squares} / size({values}) END"


def share_below(known: str, limit: str, clocks: str) -> str:
    """Known readings under a limit, over all readings."""
    return f"CASE WHEN size({known}) > 0 THEN size(filter({known}, t -> t < {limit})) / size({clocks}) END"


def with_clock_features(
    df: DataFrame,
    colors=("white", "black"),
    base: str = "base_time",
    keep_spent: bool = False,
) -> DataFrame:
    """Append the eight clock features of each colour as ``{color}_{feature}``."""

    def step(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
        return frame.withColumns({name: F.expr(text) for name, text in columns.items()})

    seconds = f"double({base})"
    df = step(df, {f"_known_{c}": known_clocks(f"clock_times_{c}", base) for c in colors})
    df = step(df, {f"_spent_{c}": seconds_spent(f"_known_{c}", seconds) for c in colors})
    df = step(
        df, {f"_{p}_{c}": text for c in colors for p, text in phase_slices(f"_spent_{c}").items()}
    )
    df = step(df, {f"{c}_avg_time_{p}": mean_of(f"_{p}_{c}") for c in colors for p in PHASES})
    last = {}
    for c in colors:
        for p in PHASES:
            last[f"{c}_time_variance_{p}"] = variance_of(f"_{p}_{c}", f"{c}_avg_time_{p}")
        known, clocks = f"_known_{c}", f"clock_times_{c}"
        last[f"{c}_low_time_move_ratio"] = share_below(known, str(LOW_SECONDS), clocks)
        last[f"{c}_time_trouble_frequency"] = share_below(
            known, f"{seconds} * {TROUBLE_SHARE}D", clocks
        )
    df = step(df, last)
    if keep_spent:
        df = step(df, {f"{c}_time_spent": f"_spent_{c}" for c in colors})
    return df.drop(*[f"_{n}_{c}" for c in colors for n in ("known", "spent", *PHASES)])
