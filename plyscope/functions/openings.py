"""Opening features from the code, the name and the first moves."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plyscope.functions.numbers import clamp, count_where

# Base aggression by first letter of the opening code.
LETTER_BASE = {"A": 50, "B": 70, "C": 65, "D": 45, "E": 55}
NEUTRAL_BASE = 50
EARLY_PLIES = 10
DEEPEST_BOOK = 20
UNNAMED_BOOK = 8


def letter_base(eco: Column) -> Column:
    letter = F.substring(eco, 1, 1)
    chain = F.when(F.lit(False), F.lit(0.0))
    for key, value in LETTER_BASE.items():
        chain = chain.when(letter == key, F.lit(float(value)))
    return chain.otherwise(F.lit(float(NEUTRAL_BASE)))


def subcode_shift(eco: Column) -> Column:
    """(sub-code − 50) / 10, or 0 when the sub-code is missing or not a number."""
    digits = F.when(F.length(eco) >= 3, F.substring(eco, 2, 2)).when(
        F.length(eco) == 2, F.substring(eco, 2, 1)
    )
    return F.coalesce((digits.try_cast("int") - 50) * 0.1, F.lit(0.0))


def early_tactics(sans: Column) -> Column:
    """Two points per capture and three per check within the first ten plies."""
    head = F.slice(sans, 1, EARLY_PLIES)
    captures = count_where(head, lambda s: s.contains("x"))
    checks = count_where(head, lambda s: s.contains("+"))
    return captures * 2 + checks * 3


def aggression_score(eco: Column, sans: Column) -> Column:
    return clamp(letter_base(eco) + subcode_shift(eco) + early_tactics(sans), 20.0, 100.0)


def book_deviation(eco: Column, name: Column) -> Column:
    words = count_where(F.split(name, r"\s+"), lambda w: w != "")
    named = F.when(F.length(name) > 0, F.least(F.lit(DEEPEST_BOOK), words + 5)).otherwise(
        F.lit(UNNAMED_BOOK)
    )
    number = F.when(F.length(eco) >= 3, F.substring(eco, 2, 1_000_000).try_cast("bigint"))
    depth = F.floor(number / 20)
    deepened = F.least(F.lit(DEEPEST_BOOK), named + F.coalesce(depth, F.lit(0)))
    return deepened.cast("int")
