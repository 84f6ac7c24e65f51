"""Plan checks through ``DataFrame.explain`` (what a Spark user reads)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def uses_broadcast_join(df: DataFrame) -> bool:
    return "BroadcastHashJoin" in plan_text(df, "simple")


def partition_filters(df: DataFrame) -> list[str]:
    """Non-empty ``PartitionFilters`` entries of the file scans."""
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df, "simple"))
    return [f for f in found if f.strip()]


def pushed_filters(df: DataFrame) -> list[str]:
    found = re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "simple"))
    return [f for f in found if f.strip()]


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)\s*$", plan_text(df, "simple"), flags=re.M)


def has_partial_aggregate(df: DataFrame) -> bool:
    text = plan_text(df, "simple")
    return "partial_" in text
