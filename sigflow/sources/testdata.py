"""Adapter from the driver's ``events`` table to the pipeline's shapes.

Every column is computed by Spark from ``events``, so the work grows with
the table. The rules (fixed; the oracle SQL repeats them):

    signal_ts                      ts
    LV ActivePower (kW)            value * (hour(ts) + 1) * 2
    Wind Speed (m/s)               double(props.k) / 4
    Theoretical_Power_Curve (KWh)  user_id * 10.0
    Wind Direction (°)             double((event_id * 37) % 360)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.functions.signals import signals_map
from sigflow.schemas import DATE_TIME, SIGNAL_KEYS, TIMESTAMP_FORMAT


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _signal_columns(ts: str = "ts") -> list[Column]:
    return [
        F.col("value") * (F.hour(ts) + 1) * 2,
        F.get_json_object("props", "$.k").try_cast("double") / 4,
        F.col("user_id") * 10.0,
        ((F.col("event_id") * 37) % 360).cast("double"),
    ]


def events_raw(events: DataFrame) -> DataFrame:
    """Events as raw CSV rows (D1); the time text has minute resolution."""
    values = _signal_columns()
    return events.select(
        F.date_format("ts", TIMESTAMP_FORMAT).alias(DATE_TIME),
        *[v.alias(k) for k, v in zip(SIGNAL_KEYS, values)],
    )


def events_telemetry(events: DataFrame) -> DataFrame:
    """Events as the telemetry table (D4), keeping the full-precision,
    time-zone-free timestamp."""
    return events.select(
        F.to_date("ts").alias("signal_date"),
        F.col("ts").alias("signal_ts"),
        F.current_date().alias("create_date"),
        F.current_timestamp().alias("create_ts"),
        signals_map(SIGNAL_KEYS, _signal_columns()).alias("signals"),
    )


#: Of so many events one comes as a message that can't be read in full.
DAMAGED_EVERY = 50


def events_messages(events: DataFrame) -> DataFrame:
    """Events as topic messages (``value``); one in ``DAMAGED_EVERY`` is cut
    off, has a word for a number, or a day that no month has, in turn."""
    kind = F.when(F.col("event_id") % DAMAGED_EVERY == 0, F.floor(F.col("event_id") / DAMAGED_EVERY) % 3)
    number = F.col("event_id").cast("string")
    cut = F.concat(F.lit('{"Date/Time":"01 01 2024 00:00","row_id":'), number)
    word = F.concat(F.lit('{"Date/Time":"01 01 2024 00:00","Wind Speed (m/s)":"calm","row_id":'), number, F.lit("}"))
    day = F.concat(F.lit('{"Date/Time":"31 02 2024 00:00","row_id":'), number, F.lit("}"))
    raw = events.select("*", *[c.alias(n) for n, c in zip([DATE_TIME, *SIGNAL_KEYS], [F.date_format("ts", TIMESTAMP_FORMAT), *_signal_columns()], strict=True)])
    whole = F.to_json(F.struct(*[F.col(f"`{n}`") for n in (DATE_TIME, *SIGNAL_KEYS)]))
    return raw.select(F.when(kind == 0, cut).when(kind == 1, word).when(kind == 2, day).otherwise(whole).alias("value"))
