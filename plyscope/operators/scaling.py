"""Standardisation, imputation, constant columns and outliers.

Fitting reads one aggregate row (two numbers per column) to the driver, as any
estimator does; applying is a narrow projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from plyscope.schema import PROFILE_IDS, STYLE_FEATURES, numeric_columns


@dataclass(frozen=True)
class Scaler:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]

    def expression(self, column: str) -> Column:
        i = self.columns.index(column)
        return (F.col(column) - F.lit(self.means[i])) / F.lit(self.scales[i])

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        return df.withColumns({prefix + c: self.expression(c) for c in self.columns})

    def sql(self, prefix: str) -> str:
        """The same projection as a statement for a saved pipeline stage."""
        items = [
            f"(`{c}` - {m!r}D) / {s!r}D AS `{prefix}{c}`"
            for c, m, s in zip(self.columns, self.means, self.scales)
        ]
        return "SELECT *, " + ", ".join(items) + " FROM __THIS__"


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population std per column; a constant column is only centred."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    n = range(len(columns))
    means = tuple(float(row[f"m{i}"] or 0.0) for i in n)
    scales = tuple(float(row[f"s{i}"] or 0.0) or 1.0 for i in n)
    return Scaler(tuple(columns), means, scales)


def standardise(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fit_scaler(fit_on if fit_on is not None else df, columns).transform(df)


def clustering_columns(df: DataFrame, wanted=STYLE_FEATURES) -> tuple[list[str], list[str]]:
    """Numeric non-id columns restricted to the wanted ones, and the wanted ones missing."""
    numeric = numeric_columns(df, exclude=PROFILE_IDS)
    if wanted is None:
        return numeric, []
    return [c for c in wanted if c in numeric], [c for c in wanted if c not in numeric]


def impute_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL -> column mean, through one scalar subquery over the table."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns])
    return df.withColumns({c: F.coalesce(F.col(c), means.select(c).scalar()) for c in columns})


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns without any spread, by one aggregate row (min = max, free of rounding)."""
    row = df.agg(*[(F.min(c) == F.max(c)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def prepare_clustering(df: DataFrame, wanted=STYLE_FEATURES) -> tuple[DataFrame, list[str], list[str]]:
    """Ids and usable features with NULLs imputed; also the kept and the missing names."""
    columns, missing = clustering_columns(df, wanted)
    dropped = set(constant_columns(df, columns))
    kept = [c for c in columns if c not in dropped]
    ids = [c for c in PROFILE_IDS if c in df.columns]
    return impute_means(df.select(*ids, *kept), kept), kept, missing


def without_outliers(df: DataFrame, columns: list[str], limit: float = 3.0) -> DataFrame:
    """Rows whose every population z-score is below ``limit`` in absolute value."""
    scaler = fit_scaler(df, columns)
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.abs(scaler.expression(c)) < limit)
    return df.where(keep)
