"""Inputs that Spark derives from the driver's tables, written once per
scale-factor folder into the shared scratch folder (``spark.checkpoint.dir``).

* the telemetry table (D4), Parquet partitioned by ``signal_date``;
* the raw CSV files (D1) with a header row, the input of the CSV scans and
  of the producer stream;
* messages, some of them damaged, the input of the subscriber by batches.

A folder is written elsewhere and published by a rename, so it is whole when
it is there; its key holds the rules that derive it.
"""

from __future__ import annotations

import hashlib
import inspect
import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.functions import signals
from sigflow.functions.signals import READINGS, readings
from sigflow.session import file_signature, new_scratch_dir, path_exists, publish, scratch_root
from sigflow.sources import testdata
from sigflow.sources.table import TableConfig, read_table, write_table
from sigflow.sources.testdata import events_messages, events_raw, events_telemetry, read_events

# Fixed value: where the raw CSV is cut into a first and a second delivery.
SECOND_DELIVERY_FROM = "2024-01-16 00:00:00"

# Queries built from several threads of one session stage each folder once.
_STAGE_LOCK = threading.Lock()


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Key of the staged copies: the folder, the size and modification time of
    its events table (read through the cluster file system) and the rules that
    derive the copies."""
    base = sf_dir.rstrip("/")
    parts = [base if "://" in base else os.path.abspath(base), inspect.getsource(testdata), inspect.getsource(signals)]
    signature = file_signature(spark, f"{base}/events.parquet")
    if signature:
        parts.append(signature)
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def stage_root(spark: SparkSession, sf_dir: str) -> str:
    return f"{scratch_root(spark)}/sigflow/stage-{_fingerprint(spark, sf_dir)}"


def _staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder ``name`` of the staged copies, written on first use: into a
    new folder, published by one rename. Applications that share the scratch
    folder don't disturb each other: the first rename counts, and a folder
    that is there is whole."""
    path = f"{stage_root(spark, sf_dir)}/{name}"
    if not path_exists(spark, path):
        with _STAGE_LOCK:
            if not path_exists(spark, path):
                own = new_scratch_dir(spark, f"staging-{name}")
                write(own)
                publish(spark, own, path)
    return path


def telemetry_table(spark: SparkSession, sf_dir: str) -> TableConfig:
    """The telemetry table for ``sf_dir``, written on first use, with the
    struct of parsed readings beside the map."""

    def write(path: str) -> None:
        # Scanned in full by most queries: rebalanced into well-sized files
        # per date, a hot date split over several files.
        rows = events_telemetry(read_events(spark, sf_dir)).withColumn(READINGS, readings())
        write_table(rows, TableConfig(path=path), mode="overwrite", rebalance=True)

    return TableConfig(path=_staged(spark, sf_dir, "telemetry", write))


def load_typed_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with its typed readings: the map is not read."""
    return read_table(spark, telemetry_table(spark, sf_dir))


def load_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table in its plain form (D4), signals in the map only."""
    return load_typed_telemetry(spark, sf_dir).drop(READINGS)


def second_delivery() -> F.Column:
    """Rows of the later delivery in the restart test; rows without a time
    belong to the first one."""
    return F.coalesce(F.col("ts") >= F.lit(SECOND_DELIVERY_FROM).cast("timestamp_ntz"), F.lit(False))


#: Files of the raw CSV folder and of the message folder, and how many of them
#: a micro-batch of the registered stream queries takes: several batches each.
CSV_FILES, FILES_PER_BATCH = 8, 3


def raw_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of raw CSV files (header row, raw column names) for ``sf_dir``."""

    def write(path: str) -> None:
        events_raw(read_events(spark, sf_dir).repartition(CSV_FILES)).write.option("header", True).csv(path)

    return _staged(spark, sf_dir, "raw_csv", write)


def message_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of topic messages, some of them damaged, for ``sf_dir``."""

    def write(path: str) -> None:
        events_messages(read_events(spark, sf_dir).repartition(CSV_FILES)).write.text(path)

    return _staged(spark, sf_dir, "messages", write)
