"""CSV folder -> message topic, as a stateless streaming query."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sigflow.operators.ingest import encode_messages
from sigflow.schemas import RAW_SCHEMA
from sigflow.sources.csv import CSV_GLOB, stream_raw_csv
from sigflow.sources.topic import TopicConfig, write_topic


def publish_csv(
    spark: SparkSession,
    csv_path: str,
    topic: TopicConfig,
    checkpoint: str,
    schema: StructType = RAW_SCHEMA,
    glob: str | None = CSV_GLOB,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Publish every row of the CSV files under ``csv_path`` as one JSON
    message (raw header names as keys, null fields omitted).

    The checkpoint records which files were published, so a restart only
    publishes new files. With ``available_now`` (default) the query handles
    what is there and stops; ``wait`` blocks until it has.
    """
    rows = stream_raw_csv(spark, csv_path, schema, glob, max_files_per_trigger)
    query = write_topic(encode_messages(rows), topic, checkpoint, available_now, processing_time)
    if wait and (available_now and not processing_time):
        query.awaitTermination()
    return query
