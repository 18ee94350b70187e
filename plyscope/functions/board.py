"""Complexity of a game from its move strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plyscope.functions.numbers import count_where

IDLE_ACTIVITY = 30.0


def san_list(moves: Column) -> Column:
    """Move strings with NULL read as the empty string."""
    return F.transform(F.coalesce(moves, F.array().cast("array<struct<move_san:string>>")),
                       lambda m: F.coalesce(m["move_san"], F.lit("")))


def tactical_marks(san: Column) -> Column:
    """One mark each for a capture, a check or mate, and a promotion."""
    return (
        san.contains("x").cast("int")
        + (san.contains("+") | san.contains("#")).cast("int")
        + san.contains("=").cast("int")
    )


def position_complexity(sans: Column) -> Column:
    marks = F.aggregate(sans, F.lit(0), lambda acc, s: acc + tactical_marks(s))
    return F.when(F.size(sans) > 0, marks / F.size(sans) * 100.0)


def capture_share(sans: Column) -> Column:
    """Stand-in for material imbalance when no positions are known."""
    return F.when(F.size(sans) > 0, count_where(sans, lambda s: s.contains("x")) / F.size(sans))


def length_activity(sans: Column) -> Column:
    """Stand-in for piece activity when no positions are known."""
    return F.when(F.size(sans) > 0, F.least(F.lit(40.0), 20.0 + F.size(sans) * 0.3))
