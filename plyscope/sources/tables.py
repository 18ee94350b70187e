"""Readers and writers of game tables and results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plyscope.functions.numbers import nan_to_null
from plyscope.schema import GAMES, GAMES_FULL

GAME_CHUNKS = "games_processed_part_*.parquet"
FULL_CHUNKS = "games_full_part_*.parquet"


def without_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in floating columns, so that averages skip unknown values."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floats}) if floats else df


def read_games(spark: SparkSession, folder: str, pattern: str = GAME_CHUNKS, schema=GAMES) -> DataFrame:
    """All game chunks of a folder, files or directories, as one table."""
    return spark.read.schema(schema).parquet(f"{folder}/{pattern}")


def read_full_games(spark: SparkSession, folder: str, pattern: str = FULL_CHUNKS, schema=GAMES_FULL) -> DataFrame:
    """All full-game chunks with moves and clocks; unused arrays are not read."""
    return spark.read.schema(schema).parquet(f"{folder}/{pattern}")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A stored feature table, also one written elsewhere with NaN for unknown."""
    return without_nan(spark.read.parquet(path))


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def materialise(df_or_builder, spark: SparkSession, path: str, force: bool = False) -> DataFrame:
    """Stage cache: reuse the table at ``path`` if it is there, else write it first.

    Takes a DataFrame or a function that builds one, which is not called on a hit.
    """
    if force or not exists(spark, path):
        df = df_or_builder() if callable(df_or_builder) else df_or_builder
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json(summary: DataFrame, path: str) -> None:
    """A small result table as JSON lines in one file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_csv(summary: DataFrame, path: str) -> None:
    """A small result table as one CSV file with a header."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema=None, multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_embedding(labelled: DataFrame, path: str) -> None:
    """Map coordinates with their cluster, keyed by player."""
    write_table(labelled.select("player", "x", "y", "cluster"), path)
