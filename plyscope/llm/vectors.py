"""Vectors of a table as blocks of numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id long, v array<double>) of the rows whose vector is there and has only finite components.

    Rows without an id take no part: they could neither be asked for nor be named in a result.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & finite)


def is_query(key: Column, every: int) -> Column:
    return F.pmod(key, F.lit(every)) == 0


BLOCK = "dims int, rows int, ids binary, data binary"


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, v) of each partition in blocks of one dimension and at most ``size`` vectors.

    ids: 64-bit integers; data: doubles, vertically: component 0 of all vectors, then component 1, and so on.
    """

    def pack(batches):
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                m = values[(ends[at] - d)[:, None] + np.arange(d)] if d else np.zeros((len(at), 0))
                held.setdefault(int(d), []).append((ids[at], m))
                while sum(len(i) for i, _ in held[int(d)]) >= size:
                    i, m = (np.concatenate(x) for x in zip(*held[int(d)], strict=True))
                    held[int(d)] = [(i[size:], m[size:])]
                    yield one(int(d), i[:size], m[:size])
        for d, parts in held.items():
            i, m = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(i):
                yield one(d, i, m)

    def one(d: int, i: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        data = np.ascontiguousarray(m.T, dtype="<f8").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([d], pa.int32()), pa.array([len(i)], pa.int32()), pa.array([i.astype("<i8").tobytes()], pa.binary()), pa.array([data], pa.binary())],
            names=["dims", "rows", "ids", "data"],
        )

    return rows.select("id", "v").mapInArrow(pack, BLOCK)


def unpack(dims: int, rows: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """ids and the vertical matrix (component, vector) of a block."""
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, "<f8").reshape(dims, rows)
