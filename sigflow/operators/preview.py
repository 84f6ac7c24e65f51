"""Previews: the reference's ``show(n)``, made deterministic and lazy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 20) -> DataFrame:
    """First ``n`` rows in a fixed order; planned as a per-partition top-n
    (TakeOrderedAndProject), never a full sort."""
    return df.orderBy(*order_by).limit(n)
