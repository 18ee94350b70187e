"""Engineered ratios of game features and the selection of model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plyscope.schema import CONTROL_FLAGS, GLOBAL_FEATURES, PHASES, numeric_columns

EPS = 1e-3


def with_ratios(features: DataFrame, color: str = "white") -> DataFrame:
    """Append the ratios whose inputs are present."""
    p = f"{color}_"
    have = set(features.columns)
    new = {}

    def col(name):
        return F.col(p + name)

    if {f"{p}avg_time_{ph}" for ph in PHASES} <= have:
        total = sum((col(f"avg_time_{ph}") for ph in PHASES[1:]), col(f"avg_time_{PHASES[0]}"))
        total = F.nullif(total, F.lit(0.0))
        new |= {f"{p}time_{ph}_frac": col(f"avg_time_{ph}") / total for ph in PHASES}
        new[f"{p}opening_vs_endgame_time_ratio"] = col("avg_time_opening") / (col("avg_time_endgame") + EPS)
    if {f"{p}time_variance_{ph}" for ph in PHASES} <= have:
        new[f"{p}time_variance_total"] = sum(
            (col(f"time_variance_{ph}") for ph in PHASES[1:]), col(f"time_variance_{PHASES[0]}")
        )
    if {f"{p}low_time_move_ratio", f"{p}time_trouble_frequency"} <= have:
        new[f"{p}low_time_to_trouble_ratio"] = col("low_time_move_ratio") / (col("time_trouble_frequency") + EPS)
    for kind in ("blunder", "mistake"):
        if {"num_moves", f"{p}{kind}_rate"} <= have:
            new[f"{p}{kind}s_per_40_moves"] = col(f"{kind}_rate") * F.col("num_moves") / 40.0
    if {"avg_position_complexity", f"{p}avg_time_middlegame"} <= have:
        new[f"{p}complexity_time_product"] = F.col("avg_position_complexity") * col("avg_time_middlegame")
    return features.withColumns(new) if new else features


def color_feature_columns(df: DataFrame, color: str) -> list[str]:
    """Numeric columns of one colour plus the game-wide ones, without ids and labels."""
    p = f"{color}_"
    ids = {f"{p}player", f"{p}skill_tier", f"{p}elo"}
    wide = {*GLOBAL_FEATURES, *CONTROL_FLAGS}
    numeric = set(numeric_columns(df))
    own = [c for c in df.columns if c.startswith(p) and c not in ids]
    shared = [c for c in (*GLOBAL_FEATURES, *CONTROL_FLAGS) if c in df.columns and c in wide]
    return [c for c in own + shared if c in numeric]


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without NULL or NaN in the given columns."""
    return df.na.drop(subset=columns)


def classification_rows(features: DataFrame, color: str = "white") -> tuple[DataFrame, list[str]]:
    """Game-level model table of one colour: ``label``, features; complete rows only.

    A row is made whole, as one struct, before it is looked at. Else the optimizer moves the filter below the steps that
    make the features and works every one out anew inside it, arrays and all.
    """
    df = with_ratios(features, color)
    columns = color_feature_columns(df, color)
    keys = [c for c in ("game_id",) if c in df.columns]
    row = F.struct(*keys, F.col(f"{color}_skill_tier").alias("label"), *columns)
    out = df.select(F.explode(F.array(row)).alias("_r")).select("_r.*")
    return complete_cases(out, ["label", *columns]), columns
