"""Clock features against a plain-Python reading of the rules."""

from __future__ import annotations

import math
import random

import pytest

from plyscope.functions.clock import with_clock_features
from plyscope.schema import CLOCK_FEATURES, PHASES

SCHEMA = "game_id long, base_time int, clock_times_white array<double>"


def expected(clocks, base):
    nothing = dict.fromkeys(CLOCK_FEATURES)
    if clocks is None or len(clocks) < 5 or base is None:
        return nothing
    known = [c for c in clocks if c is not None and not math.isnan(c)]
    if not known:
        return nothing
    spent = [max(0.0, a - b) for a, b in zip([float(base), *known], known)]
    parts = {
        "opening": spent[:5],
        "middlegame": spent[5:12] if len(spent) > 12 else [],
        "endgame": spent[12:] if len(spent) > 12 else [],
    }
    out = {}
    for p, v in parts.items():
        mean = sum(v) / len(v) if v else None
        out[f"avg_time_{p}"] = mean
        out[f"time_variance_{p}"] = sum((x - mean) ** 2 for x in v) / len(v) if len(v) > 1 else None
    out["low_time_move_ratio"] = sum(c < 30 for c in known) / len(clocks)
    out["time_trouble_frequency"] = sum(c < base * 0.1 for c in known) / len(clocks)
    return out


NAN = float("nan")
CASES = {
    "null list": (None, 300),
    "empty": ([], 300),
    "four": ([290.0, 280.0, 270.0, 260.0], 300),
    "five": ([290.0, 280.0, 270.0, 260.0, 251.5], 300),
    "six": ([290.0, 280.0, 270.0, 260.0, 250.0, 200.0], 300),
    "twelve": ([300.0 - 7 * i for i in range(1, 13)], 300),
    "thirteen": ([300.0 - 7 * i - i * i / 8 for i in range(1, 14)], 300),
    "fourteen": ([300.0 - 3 * i - i * i / 8 for i in range(1, 15)], 300),
    "all null": ([None] * 6, 300),
    "one known": ([None, None, 250.0, None, None], 300),
    "nan inside": ([290.0, NAN, 270.0, None, 250.0], 300),
    "increment": ([302.0, 304.0, 299.0, 305.0, 290.0], 300),
    "no base time": ([290.0, 280.0, 270.0, 260.0, 250.0], None),
    "limits": ([30.0, 29.99, 30.01, 18.0, 17.99], 180),
}


def rows_of(spark, cases):
    data = [(i, base, clocks) for i, (clocks, base) in enumerate(cases)]
    df = with_clock_features(spark.createDataFrame(data, SCHEMA), colors=("white",))
    return {r["game_id"]: r for r in df.collect()}


def test_edge_cases(spark):
    rows = rows_of(spark, CASES.values())
    for i, (name, (clocks, base)) in enumerate(CASES.items()):
        for feature, want in expected(clocks, base).items():
            assert rows[i][f"white_{feature}"] == pytest.approx(want, abs=1e-9), (name, feature)


def test_random_games(spark):
    rng = random.Random(5)
    cases = []
    for _ in range(200):
        base = rng.choice([60, 180, 300, 900])
        clock, clocks = float(base), []
        for _ in range(rng.randrange(0, 45)):
            clock = max(0.0, clock - rng.random() * base / 20 + rng.choice([0, 0, 3]))
            clocks.append(None if rng.random() < 0.1 else round(clock, 2))
        cases.append((clocks, base))
    rows = rows_of(spark, cases)
    for i, (clocks, base) in enumerate(cases):
        for feature, want in expected(clocks, base).items():
            assert rows[i][f"white_{feature}"] == pytest.approx(want, abs=1e-9)


def test_phase_hole(spark):
    """Moves six to twelve of a list of at most twelve belong to no phase."""
    row = rows_of(spark, [CASES["twelve"]])[0]
    assert row["white_avg_time_opening"] is not None
    assert all(row[f"white_avg_time_{p}"] is None for p in PHASES[1:])
