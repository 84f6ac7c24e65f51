"""Topic -> table by idempotent micro-batches, with a ledger.

Each micro-batch is written as a batch job (``foreachBatch``), so adaptive
execution works inside it: a rebalance sizes the files and splits a hot date.
The batch's id is a partition column of the table. A batch that runs again
after a failure overwrites just its own partitions, so it leaves the same rows
however far it had come; one that is in the ledger is not written again.

The ledger has a row per batch with the counts that the write itself observed:
no second scan. Texts that could not be read in full go to a quarantine table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigflow.functions.signals import READINGS, readings
from sigflow.operators.ingest import MALFORMED
from sigflow.schemas import TIMESTAMP_FORMAT
from sigflow.session import path_exists
from sigflow.sources.table import TableConfig, read_table
from sigflow.sources.topic import TopicConfig
from sigflow.streaming.dedupe import only_data_batches
from sigflow.streaming.subscriber import telemetry_stream

BATCH = "ingest_batch"


def batch_table(table: TableConfig) -> TableConfig:
    """``table`` with the batch as its last partition column."""
    keys = [k for k in table.partition_by if k != BATCH]
    return replace(table, partition_by=(*keys, BATCH))


def overwrite_partitions(rows: DataFrame, cfg: TableConfig) -> None:
    """Write the rows in place of what their partitions hold."""
    writer = rows.write.format(cfg.format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if cfg.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(cfg.max_records_per_file))
    writer.partitionBy(*cfg.partition_by).save(cfg.path)


COUNTS = ("rows_written", "rows_malformed", "rows_untimed")


def _counts(seen: Observation) -> dict[str, int]:
    """What a successful write observed. Adaptive execution replaces the plan
    of a batch without rows, and its metrics go with it."""
    try:
        return seen.get
    except Py4JJavaError:
        return dict.fromkeys(COUNTS, 0)


def write_batch(
    rows: DataFrame,
    batch_id: int,
    table: TableConfig,
    ledger: str,
    writer: str,
    quarantine: TableConfig | None = None,
    after_write: Callable[[int], None] | None = None,
) -> None:
    """Write one micro-batch and its row of the ledger, once."""
    done = f"{ledger}/writer={writer}/batch_id={batch_id}"
    spark = rows.sparkSession
    if path_exists(spark, f"{done}/_SUCCESS"):
        return
    cfg, name = batch_table(table), f"{writer}-{batch_id}"
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    # Streams turn adaptive execution off; the write is a batch job.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        seen = Observation()
        counted = rows.withColumn(BATCH, F.lit(name)).observe(
            seen,
            *[c.alias(n) for n, c in zip(COUNTS, (F.count(F.lit(1)), F.count(MALFORMED), F.count_if(F.col("signal_ts").isNull())), strict=True)],
        )
        keys = [k for k in cfg.partition_by if k != BATCH]
        overwrite_partitions(counted.hint("rebalance", *keys).sortWithinPartitions(*keys, "signal_ts"), cfg)
        counts = _counts(seen)
        if quarantine is not None and counts["rows_malformed"]:
            own = spark.read.format(cfg.format).load(cfg.path).filter(F.col(BATCH) == name)
            bad = own.filter(F.col(MALFORMED).isNotNull()).select(MALFORMED, "create_ts", F.lit(name).alias(BATCH))
            overwrite_partitions(bad, replace(quarantine, partition_by=(BATCH,)))
        if after_write:
            after_write(batch_id)
        row = spark.createDataFrame([tuple(counts[c] for c in COUNTS)], ", ".join(f"{c} bigint" for c in COUNTS))
        row.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(done)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def ingest_batches(
    spark: SparkSession,
    topic: TopicConfig,
    table: TableConfig,
    ledger: str,
    checkpoint: str,
    quarantine: TableConfig | None = None,
    fmt: str = TIMESTAMP_FORMAT,
    dedupe_within: str | None = None,
    typed: bool = False,
    processing_time: str | None = None,
    wait: bool = True,
    writer: str | None = None,
    after_write: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Append the topic's messages to the table by idempotent batches.

    ``ledger`` is a folder (``read_ledger``), ``quarantine`` a table of the
    texts that could not be read in full. Rows are those of ``ingest_topic``
    with ``malformed``, ``ingest_batch`` and, if ``typed``, the struct of
    parsed readings. ``writer`` names the query in batch ids, by default after
    its checkpoint: queries that share a table must not share a name. Size
    batches by the topic's ``max_files_per_trigger`` or offsets.
    ``after_write`` is called when a batch's rows are written and before they
    are recorded.
    """
    rows = telemetry_stream(spark, topic, fmt, dedupe_within, malformed=True)
    if typed:
        rows = rows.withColumn(READINGS, readings())
    name = writer or hashlib.sha1(checkpoint.encode()).hexdigest()[:10]

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, table, ledger, name, quarantine, after_write)

    stream = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    stream = stream.trigger(processingTime=processing_time) if processing_time else stream.trigger(availableNow=True)
    with only_data_batches(spark):
        query = stream.start()
    if wait and not processing_time:
        query.awaitTermination()
    return query


def read_batches(spark: SparkSession, table: TableConfig) -> DataFrame:
    """The table that ``ingest_batches`` writes."""
    return read_table(spark, batch_table(table))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """A row per recorded batch: writer, batch_id, rows_written,
    rows_malformed, rows_untimed, written_at."""
    return spark.read.option("basePath", ledger).parquet(f"{ledger}/writer=*")


def read_quarantine(spark: SparkSession, quarantine: TableConfig) -> DataFrame:
    """Texts that could not be read in full, each as often as it came."""
    return spark.read.format(quarantine.format).load(quarantine.path)
