"""Helpers shared by the operators: words as hashes, text blocks, stored tables, unique rows."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plyscope.session import cut_lineage, scratch_path

#: Bytes of text that a task turns into arrays at once.
BLOCK_BYTES = 1 << 21

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small intermediate table."""
    return cut_lineage(df)


def tasks_for(rows: int, per_task: int) -> int:
    return max(1, -(-rows // per_task))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse, for 2**bits positions."""
    n = 1 << bits
    out = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
        p = np.ones(n, dtype=np.uint64)
        size, step = 1, base
        while size < n:
            p[size : 2 * size] = p[:size] * np.uint64(step)
            size, step = 2 * size, step * step & _MASK
        out.append(p)
    return out[0], out[1]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Words between ASCII white space: 64-bit hash, row, start and end of each.

    ``data`` holds the UTF-8 of all rows one behind the other, row i from offsets[i] to offsets[i + 1].
    """
    empty = np.zeros(0, dtype=np.int64)
    if not len(data):
        return empty.astype(np.uint64), empty, empty, empty
    inside = ~_SPACE[data]
    first = np.empty(len(data) + 1, dtype=bool)
    first[0] = True
    first[1:-1] = ~inside[:-1]
    first[-1] = True
    cuts = offsets[1:-1]
    first[cuts[cuts < len(data)]] = True
    starts = np.flatnonzero(first[:-1] & inside)
    if not len(starts):
        return empty.astype(np.uint64), empty, empty, empty
    after = np.empty(len(data), dtype=bool)
    after[:-1] = ~inside[1:] | first[1:-1]
    after[-1] = True
    ends = np.flatnonzero(after & inside) + 1
    power, inverse = _powers((max(BLOCK_BYTES, len(data)) - 1).bit_length())
    values = (_LOWER[data] if lower else data).astype(np.uint64)
    values += np.uint64(1)
    values *= inside
    values *= power[: len(data)]
    hashes = np.add.reduceat(values, starts)
    hashes *= inverse[starts]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return mix(hashes), rows, starts, ends


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` bytes (or one longer row): first row, row behind, bytes, offsets.

    NULL counts as empty.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def shingle_hashes(words: np.ndarray, rows: np.ndarray, size: int):
    """Hash and row of every run of ``size`` words; a shorter row has one shingle of all its words."""
    if not len(words):
        return words, rows
    n = np.bincount(rows)
    begin = np.concatenate([[0], np.cumsum(n)[:-1]])
    total = np.zeros(len(words), dtype=np.uint64)
    valid = np.arange(len(words)) - begin[rows]
    last = n[rows] - valid
    for k in range(min(size, len(words))):
        step = np.uint64(pow(_MULTIPLIER, k + 1, 1 << 64) | 1)
        part = words * step
        total[: len(words) - k] += np.where(last[: len(words) - k] > k, part[k:] if k else part, np.uint64(0))
    keep = (last >= size) | ((valid == 0) & (n[rows] < size))
    return mix(total[keep]), rows[keep]


def uniform(h: np.ndarray) -> np.ndarray:
    """Hash values as numbers above 0 and at most 1."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def list_column(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of the component of every linked node.

    Every round points each node at the smallest label among its neighbours and then at that label's own label;
    a reliable checkpoint ends the round. Only minima are aggregated, so a hub costs no memory.
    """
    ends = links.where(F.col(a) != F.col(b)).select(F.col(a).alias("s"), F.col(b).alias("t")).distinct()
    edges = settled(ends.union(ends.select("t", "s")).distinct())
    labels = edges.groupBy(F.col("s").alias("node")).agg(F.min(F.least("s", "t")).alias("root"))
    while True:
        seen = (
            edges.join(labels.select(F.col("node").alias("t"), "root"), "t")
            .groupBy(F.col("s").alias("node"))
            .agg(F.min("root").alias("seen"))
        )
        lower = labels.join(seen, "node").select("node", "root", F.least("root", "seen").alias("low"))
        lower = settled(lower)
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("over"))
        new = settled(
            lower.join(jump, "low", "left").select("node", "root", F.least("low", F.coalesce("over", "low")).alias("new"))
        )
        labels = new.select("node", F.col("new").alias("root"))
        if new.where("new < root").isEmpty():
            return labels
