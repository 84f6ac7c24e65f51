"""Categorical band over a numeric column (searched CASE)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigflow.schemas import BAND_BOUNDS, BAND_LABELS

_DEFAULT = object()


def band(
    value: Column,
    bounds: Sequence[float] = BAND_BOUNDS,
    labels: Sequence[str] = BAND_LABELS,
    null_label=_DEFAULT,
) -> Column:
    """``labels[i]`` for ``bounds[i-1] <= value < bounds[i]``; the last label
    for everything from the last bound up.

    Null and NaN fall through every comparison and so get the last label, as
    a ``when ... otherwise`` chain gives them. Pass ``null_label`` (for
    example ``None``) to give them their own value instead.
    """
    bounds = list(bounds)
    if len(labels) != len(bounds) + 1:
        raise ValueError("need exactly one label more than bounds")
    if bounds != sorted(bounds):
        raise ValueError("bounds must ascend")
    expr = None
    if null_label is not _DEFAULT:
        expr = F.when(value.isNull() | F.isnan(value), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        cond = value < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def generation_indicator(avg_active_power: Column, **kwargs) -> Column:
    """Low / Medium / High / Exceptional on the hourly average active power."""
    return band(avg_active_power, **kwargs)
