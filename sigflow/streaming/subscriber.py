"""Message topic -> telemetry table, as a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sigflow.operators.ingest import MALFORMED, decode_messages, decode_telemetry, shape_telemetry
from sigflow.schemas import TIMESTAMP_FORMAT
from sigflow.sources.table import TableConfig, stream_to_table
from sigflow.sources.topic import TopicConfig, read_topic
from sigflow.streaming.dedupe import drop_repeats, only_data_batches


def telemetry_stream(
    spark: SparkSession,
    topic: TopicConfig,
    fmt: str = TIMESTAMP_FORMAT,
    dedupe_within: str | None = None,
    malformed: bool = False,
) -> DataFrame:
    """Decoded and shaped telemetry rows from the topic (unbounded).

    Delivery into the topic is at least once, and the reference keeps
    replayed duplicates. ``dedupe_within`` (e.g. ``"1 hour"``) opts into
    dropping readings that come again within that delay (``drop_repeats``):
    one stateful operator over the batch, which is read once. ``malformed``
    adds the text of messages that could not be read in full.
    """
    messages = read_topic(spark, topic, streaming=True)
    if not (dedupe_within or malformed):
        return shape_telemetry(decode_messages(messages), fmt)
    rows = decode_telemetry(messages, fmt)
    if dedupe_within:
        rows = drop_repeats(rows, dedupe_within)
    return rows if malformed else rows.drop(MALFORMED)


def ingest_topic(
    spark: SparkSession,
    topic: TopicConfig,
    table: TableConfig,
    checkpoint: str,
    fmt: str = TIMESTAMP_FORMAT,
    dedupe_within: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    wait: bool = True,
    files_per_partition: int | None = None,
) -> StreamingQuery:
    """Append the topic's messages to the telemetry table.

    Each record becomes one row; a malformed message becomes a row with null
    time and a map of null values (filter with ``quarantine_split``).
    ``files_per_partition`` bounds the files each batch writes per date
    (see ``stream_to_table``).
    """
    rows = telemetry_stream(spark, topic, fmt, dedupe_within)
    with only_data_batches(spark):
        query = stream_to_table(
            rows, table, checkpoint, available_now, processing_time, files_per_partition=files_per_partition
        )
    if wait and (available_now and not processing_time):
        query.awaitTermination()
    return query
