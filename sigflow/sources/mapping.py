"""Signal-name dimension: inline rows or the task's JSON array."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.schemas import MAPPING_SCHEMA, SIGNAL_MAPPING, SIGNAL_MAPPING_JSON

MAPPING_ARRAY_TYPE = "array<struct<sig_name:string,sig_mapping_name:string>>"


def mapping_frame(spark: SparkSession, pairs: Iterable[tuple[str, str]] = SIGNAL_MAPPING) -> DataFrame:
    """Inline literal table with an explicit schema, one row per
    ``sig_name`` (repeated identical pairs are kept once; a name mapped two
    ways is an error)."""
    unique: dict[str, str] = {}
    for name, mapped in pairs:
        if name in unique and unique[name] != mapped:
            raise ValueError(f"{name!r} is mapped to both {unique[name]!r} and {mapped!r}")
        unique[name] = mapped
    return spark.createDataFrame(list(unique.items()), MAPPING_SCHEMA)


def mapping_from_json(spark: SparkSession, text: str = SIGNAL_MAPPING_JSON) -> DataFrame:
    """Dimension from a JSON array of {sig_name, sig_mapping_name}.

    Parsed by ``from_json`` and expanded by ``inline``. Repeated identical
    entries (the task's JSON lists one twice) are removed inside the array
    with ``array_distinct``, so the result has one row per name without a
    shuffle; a name mapped two different ways fails the query.
    """
    return spark.range(1).select(F.inline(_checked_entries(F.lit(text))))


def mapping_from_files(spark: SparkSession, path: str) -> DataFrame:
    """Dimension from all JSON arrays below ``path`` (one per file), read by
    the executors; one row per name, a name mapped two ways fails."""
    files = spark.read.text(path, wholetext=True)
    return unique_mapping(files.select(F.inline(_checked_entries(F.col("value")))))


def _checked_entries(text: Column) -> Column:
    """The distinct entries of a JSON array, or an error."""
    entries = F.array_distinct(F.from_json(text, MAPPING_ARRAY_TYPE))
    names = F.transform(entries, lambda e: e["sig_name"])
    return (
        F.when(
            entries.isNull(),
            F.raise_error(F.lit("mapping JSON is not an array of {sig_name, sig_mapping_name}")).cast(
                MAPPING_ARRAY_TYPE
            ),
        )
        .when(F.size(F.array_distinct(names)) == F.size(entries), entries)
        .otherwise(F.raise_error(F.lit("mapping JSON maps a sig_name two ways")).cast(MAPPING_ARRAY_TYPE))
    )


def unique_mapping(mapping: DataFrame) -> DataFrame:
    """One row per ``sig_name``; a name mapped two ways fails the query."""
    name = F.col("sig_mapping_name")
    error = F.raise_error(F.concat(F.lit("mapped two ways: "), F.first("sig_name"))).cast("string")
    one = F.when(F.min(name).eqNullSafe(F.max(name)), F.min(name)).otherwise(error)
    return mapping.groupBy("sig_name").agg(one.alias("sig_mapping_name"))
