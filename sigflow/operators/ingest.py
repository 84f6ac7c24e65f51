"""Message encoding and decoding, and the telemetry shape (batch or stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.functions.signals import decode_json, message_value, parse_signal_ts, quoted, signals_map
from sigflow.schemas import DATE_TIME, MESSAGE_SCHEMA, RAW_SCHEMA, SIGNAL_KEYS, TIMESTAMP_FORMAT


def encode_messages(raw: DataFrame) -> DataFrame:
    """Raw rows -> one JSON ``value`` per row, keyed by the raw column names."""
    return raw.select(message_value(raw))


#: Column with the text of a message that could not be read in full.
MALFORMED = "malformed"


def decode_messages(messages: DataFrame, schema=MESSAGE_SCHEMA) -> DataFrame:
    """``value`` (string or binary) -> the raw columns. Malformed messages
    become all-null rows and are kept; ``row_id`` is accepted and dropped."""
    decoded = messages.select(decode_json(F.col("value"), schema).alias("m")).select("m.*")
    return decoded.select(*[quoted(f.name) for f in RAW_SCHEMA.fields])


def decode_telemetry(messages: DataFrame, fmt: str = TIMESTAMP_FORMAT, schema=MESSAGE_SCHEMA) -> DataFrame:
    """``shape_telemetry(decode_messages(...))`` and a column ``malformed``:
    the message's text if it is no JSON object, has a field of another type,
    or its time is missing or does not parse; else null."""
    text = F.col("value").cast("string")
    message = decode_json(text, schema, MALFORMED)
    rows = messages.select(text.alias(MALFORMED), message.alias("m"))
    raw = rows.select(*[F.col("m")[f.name].alias(f.name) for f in RAW_SCHEMA.fields], MALFORMED, (F.col("m").isNull() | F.col("m")[MALFORMED].isNotNull()).alias("damaged"))
    shaped = shape_telemetry(raw, fmt, MALFORMED, "damaged")
    kept = F.when(F.col("damaged") | F.col("signal_ts").isNull(), F.col(MALFORMED))
    return shaped.withColumn(MALFORMED, kept).drop("damaged")


def shape_telemetry(raw: DataFrame, fmt: str = TIMESTAMP_FORMAT, *more: str) -> DataFrame:
    """Raw columns -> telemetry table rows.

    The timestamp is parsed once and the date derived from it; text that
    does not match ``fmt`` strictly gives null time and date (row kept).
    Ingest date and time are fixed per query execution (per micro-batch in
    a stream). Signal values become their text form in the map. The columns
    ``more`` come last, as they are.
    """
    ts = parse_signal_ts(quoted(DATE_TIME), fmt)
    return raw.select(ts.alias("signal_ts"), *[quoted(k) for k in SIGNAL_KEYS], *more).select(
        F.to_date("signal_ts").alias("signal_date"),
        "signal_ts",
        F.current_date().alias("create_date"),
        F.current_timestamp().alias("create_ts"),
        signals_map(SIGNAL_KEYS).alias("signals"),
        *more,
    )


def quarantine_split(telemetry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows whose time text did not parse go to ``bad``."""
    bad = F.col("signal_ts").isNull()
    return telemetry.filter(~bad), telemetry.filter(bad)
