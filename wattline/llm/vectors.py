"""Vectors as packed rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str, allow_zero: bool) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers."""
    x = F.col(vector).cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    sound = F.col(vector).isNotNull() & (F.size(x) > 0) & ~F.exists(x, bad)
    return sound if allow_zero else sound & F.exists(x, lambda c: c != 0)


def most_common_size(vectors: DataFrame, vector: str) -> int:
    """The dimension that most vectors have; ties go to the smaller. 0 without vectors."""
    rows = vectors.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").take(1)
    return rows[0]["n"] if rows else 0


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """(rows, dims) of a column of lists that all have that size."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dims)


def packed(rows: np.ndarray) -> pa.Array:
    """A binary value per row."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)
