"""Column expressions over telemetry signals (all built-in, JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sigflow.schemas import SIGNAL_KEYS, TIMESTAMP_FORMAT, TYPED_COLUMNS


def quoted(name: str) -> Column:
    """Column by exact name; signal names contain spaces, '/' and parentheses."""
    return F.col("`" + name.replace("`", "``") + "`")


def signal_value(key: str, map_col: str = "signals") -> Column:
    """Map lookup + text -> double. Missing key or unparsable text gives null.

    ``try_cast`` keeps the null-on-bad-text result under ANSI mode, where a
    plain cast would fail the query.
    """
    return F.col(map_col)[key].try_cast("double")


#: Struct column of parsed readings that the sink can write beside the map.
READINGS = "readings"


def readings(map_col: str = "signals") -> Column:
    """The map's signals as a struct of doubles, one field per typed column."""
    return F.struct(*[signal_value(k, map_col).alias(n) for k, n in zip(SIGNAL_KEYS, TYPED_COLUMNS)])


def reading(rows: DataFrame, key: str) -> Column:
    """A signal's value: the field of the typed struct if ``rows`` have one
    (only that column is read then), else looked up in the map and parsed."""
    if READINGS in rows.columns:
        return F.col(READINGS)[TYPED_COLUMNS[SIGNAL_KEYS.index(key)]]
    return signal_value(key)


def signals_map(keys: Sequence[str] = SIGNAL_KEYS, values: Sequence[Column] | None = None) -> Column:
    """Wide columns -> ``map<string,string>`` (null values kept as null).

    Keys are literals; a repeated key would fail at run time, so it is
    rejected here.
    """
    if len(set(keys)) != len(keys):
        raise ValueError(f"duplicate signal keys: {list(keys)}")
    if values is None:
        values = [quoted(k) for k in keys]
    if len(values) != len(keys):
        raise ValueError("keys and values differ in length")
    return F.map_from_arrays(
        F.array(*[F.lit(k) for k in keys]),
        F.array(*[v.cast("string") for v in values]),
    )


def parse_signal_ts(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text -> timestamp with a strict pattern; malformed text gives null."""
    return F.try_to_timestamp(text, F.lit(fmt))


def message_value(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """Whole row -> one JSON object keyed by column name; null fields omitted."""
    names = list(columns) if columns is not None else df.columns
    return F.to_json(F.struct(*[quoted(c) for c in names])).alias("value")


def decode_json(value: Column, schema: StructType, malformed: str | None = None) -> Column:
    """JSON text -> struct, permissive: malformed text gives a struct of nulls,
    a wrong-typed field gives null for that field only, unknown fields are
    ignored. With ``malformed`` the struct has one more field of that name,
    which keeps the text of such a record."""
    options = {"mode": "PERMISSIVE"}
    if malformed:
        schema = StructType(list(schema.fields)).add(malformed, "string")
        options["columnNameOfCorruptRecord"] = malformed
    return F.from_json(value.cast("string"), schema, options)
