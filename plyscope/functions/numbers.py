"""Small numeric and array expressions shared by the feature families."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def count_where(values: Column, predicate) -> Column:
    return F.size(F.filter(values, predicate))


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def hash_fraction(*parts) -> Column:
    """A reproducible number in [0, 1) from the md5 of the parts."""
    digest = F.md5(F.concat_ws("|", *[F.lit(p) if not isinstance(p, Column) else p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
