"""Joins against dimension tables whose size is checked before anything is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.workspace import shared_root

BROADCAST_BYTES = 64 * 1024 * 1024


def stored_bytes(df: DataFrame) -> Column:
    """Aggregate expression: bytes of all rows, 16 per fixed-width field plus text length."""
    fixed = 16 * len(df.columns)
    texts = [
        F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0))
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))
    ]
    width = F.lit(fixed)
    for text in texts:
        width = width + text
    return F.coalesce(F.sum(width.cast("bigint")), F.lit(0))


def fits_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a dimension. One distributed aggregate; only its single number reaches the driver."""
    return dim.agg(stored_bytes(dim).alias("n")).first()["n"] <= max_bytes


def settle(df: DataFrame) -> DataFrame:
    """Write a derived table to the checkpoint folder once, so that measuring and using it does not
    compute it again."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts to a dimension.

    A dimension measured below ``max_bytes`` is broadcast, so the facts are not shuffled at all.
    Beyond it both sides are shuffled on the key and nothing is repeated; adaptive execution splits
    the partitions of a hot key. Works for ``inner``, ``left``, ``left_semi`` and ``left_anti``, where
    unmatched rows come from the facts. ``max_bytes`` of zero skips the measurement, for a right side
    that is itself made from facts.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if max_bytes and fits_broadcast(dim, max_bytes):
        return facts.join(F.broadcast(dim), on, how)
    return facts.join(dim, on, how)
