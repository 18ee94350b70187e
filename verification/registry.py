"""One entry per query: a Spark function and, where SQL can say it, an oracle.

Both results are put into the same shape: integers as bigint, and doubles rounded to six
places after adding 1e-9, so that a value on a rounding edge falls the same way in both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from verification.views import VIEWS


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def comparable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double") + F.lit(1e-9), 6)
        elif isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double") + F.lit(1e-9), 6)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def names(text) -> list[str]:
    return text.split() if isinstance(text, str) else list(text)


def oracle(body: str, doubles="", ints="", recursive: bool = False) -> str:
    """The views, the body, and the common shape of its columns."""
    fixed = [f'round(CAST("{c}" AS DOUBLE) + 1e-9, 6) AS "{c}"' for c in names(doubles)]
    fixed += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in names(ints)]
    replace = f" REPLACE ({', '.join(fixed)})" if fixed else ""
    head = "WITH RECURSIVE " if recursive else "WITH "
    return f"{head}{VIEWS},\nresult AS (\n{body}\n)\nSELECT *{replace} FROM result"


def query(name: str, sql: str | None = None, d="", i="", recursive: bool = False):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = function.__doc__
        if name in ENTRIES:
            raise ValueError(f"registered twice: {name}")
        ENTRIES[name] = Entry(run, oracle(sql, d, i, recursive) if sql else None)
        return function

    return register
