"""Equi-join against a dimension, broadcast only behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a dimension's rows, as JSON text, up to which it is broadcast.
MAX_BROADCAST_BYTES = 8 << 20


def dimension_bytes(dim: DataFrame) -> int:
    """Bytes of the rows of ``dim`` as JSON text (one pass over it)."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")
    return dim.agg(size).first()["size"] or 0


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fact`` to ``dim``; ``dim`` is broadcast when its rows take at
    most ``max_broadcast_bytes``, however many they are. A larger dimension
    takes a merge join, so the broadcast never grows with the data."""
    small = dimension_bytes(dim) <= max_broadcast_bytes
    return fact.join(F.broadcast(dim) if small else dim.hint("merge"), on=on, how=how)
