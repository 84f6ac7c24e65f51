"""Message topic: a Kafka topic when the connector is installed, otherwise a
folder of JSON-lines files written by a streaming file sink.

Both forms carry one JSON message per record in a ``value`` string column.
The file form is read from the start on every new query (like
``startingOffsets=earliest``), whatever the files' age, and only committed files are visible, since
readers of a file-sink folder go through its ``_spark_metadata`` log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigflow.sources.csv import MAX_FILE_AGE


@dataclass(frozen=True)
class TopicConfig:
    kind: str = "files"  # "files" or "kafka"
    path: str | None = None  # folder of the file topic
    bootstrap_servers: str | None = None  # Kafka only
    topic: str | None = None  # Kafka only
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_files_per_trigger: int | None = None  # file topic only
    max_offsets_per_trigger: int | None = None  # Kafka only

    def __post_init__(self):
        if self.kind not in ("files", "kafka"):
            raise ValueError(f"unknown topic kind {self.kind!r}")
        if self.kind == "files" and not self.path:
            raise ValueError("a file topic needs a path")
        if self.kind == "kafka" and not (self.bootstrap_servers and self.topic):
            raise ValueError("a Kafka topic needs bootstrap_servers and topic")


def read_topic(spark: SparkSession, cfg: TopicConfig, streaming: bool = True) -> DataFrame:
    """Topic records as a DataFrame with one ``value string`` column."""
    if cfg.kind == "kafka":
        reader = spark.readStream if streaming else spark.read
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
            .option("subscribe", cfg.topic)
            .option("startingOffsets", cfg.starting_offsets)
            .option("failOnDataLoss", str(cfg.fail_on_data_loss).lower())
        )
        if streaming and cfg.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", int(cfg.max_offsets_per_trigger))
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if streaming:
        reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
        if cfg.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(cfg.max_files_per_trigger))
        return reader.text(cfg.path)
    return spark.read.text(cfg.path)


def write_topic(
    messages: DataFrame,
    cfg: TopicConfig,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start a streaming sink of ``value`` strings into the topic.

    ``available_now`` processes what is there and stops (call
    ``awaitTermination``); pass ``processing_time`` for a long-running query.
    """
    writer = messages.select("value").writeStream.outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    if cfg.kind == "kafka":
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
            .option("topic", cfg.topic)
            .start()
        )
    return writer.format("text").start(cfg.path)
