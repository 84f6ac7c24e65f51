"""Telemetry table: Parquet by default, Delta when its package is installed.

Written partitioned by ``signal_date`` so a one-day read prunes to one folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigflow.schemas import TELEMETRY_SCHEMA
from sigflow.session import path_exists


@dataclass(frozen=True)
class TableConfig:
    path: str
    format: str = "parquet"  # "parquet" or "delta"
    partition_by: Sequence[str] = field(default=("signal_date",))
    max_records_per_file: int | None = None


def read_table(spark: SparkSession, cfg: TableConfig) -> DataFrame:
    """Batch scan of the table (also what a stream has committed so far).

    A telemetry table comes in the column order of D4, other columns after
    it. Its date is a date even where all are null (a table of malformed
    messages only)."""
    rows = spark.read.format(cfg.format).load(cfg.path)
    first = [f.name for f in TELEMETRY_SCHEMA]
    if not set(first) <= set(rows.columns):
        return rows
    date = F.col("signal_date").cast("date").alias("signal_date")
    return rows.select(date, *first[1:], *[c for c in rows.columns if c not in first])


def write_table(
    df: DataFrame,
    cfg: TableConfig,
    mode: str = "append",
    cluster_by: Sequence[str] | None = None,
    num_partitions: int | None = None,
    rebalance: bool = False,
) -> None:
    """Batch write, partitioned by ``cfg.partition_by``.

    Layouts:

    * default: every task writes its own rows as they are (no shuffle;
      right when the input is already ordered by time and its tasks are of
      a good size).
    * ``rebalance=True``: a ``REBALANCE`` hint on the partition columns.
      Adaptive execution sizes the write tasks to
      ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and splits a date
      that holds a large share of the rows over several tasks, so files
      come out of a similar size whatever the skew; rows are sorted by time
      within each task.
    * ``cluster_by=("signal_date", "signal_ts")``: range partitioning on
      those columns, then a sort; each task holds one time range, a hot date
      is cut into many ranges. ``num_partitions`` fixes the number of ranges
      (otherwise ``spark.sql.shuffle.partitions``, coalesced by AQE).

    Scan balance depends on file sizes: Spark packs small files into splits
    by bytes, so a few dense files next to many tiny ones end up in one
    split. Prefer ``rebalance`` for tables that will be scanned in full.
    """
    if path_exists(df.sparkSession, f"{cfg.path}/_spark_metadata"):
        # Readers of a stream's folder see only what its log lists.
        raise ValueError(f"{cfg.path} is written by a stream: a batch write there would stay invisible")
    if rebalance:
        keys = list(cfg.partition_by)
        df = df.hint("rebalance", *keys) if keys else df.hint("rebalance")
        df = df.sortWithinPartitions(*(keys + (["signal_ts"] if "signal_ts" in df.columns else [])))
    elif cluster_by:
        cols = list(cluster_by)
        df = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
        df = df.sortWithinPartitions(*cols)
    writer = df.write.format(cfg.format).mode(mode)
    if cfg.partition_by:
        writer = writer.partitionBy(*cfg.partition_by)
    if cfg.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(cfg.max_records_per_file))
    writer.save(cfg.path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str] = ("signal_date", "hour_of_day")) -> DataFrame:
    """Write ``df`` as a table of the session's catalog, bucketed and sorted
    by date and hour (added if missing), and return it.

    An aggregate by these keys reads each bucket in a task and needs no
    shuffle (``hourly_averages``). Rows are dealt by the keys, so an hour that
    holds much of the table makes one bucket large: use ``write_table`` with
    ``rebalance`` for such data. Sessions with another catalog register the
    folder by ``open_bucketed``.
    """
    if "hour_of_day" in keys and "hour_of_day" not in df.columns:
        df = df.withColumn("hour_of_day", F.hour("signal_ts"))
    # One task per bucket, so that it is one file.
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: str, buckets: int, keys: Sequence[str] = ("signal_date", "hour_of_day")) -> DataFrame:
    """Register a folder that ``write_bucketed`` wrote; ``schema`` as DDL."""
    names = ", ".join(keys)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def spread_by_partition(df: DataFrame, keys: Sequence[str], files_per_partition: int) -> DataFrame:
    """Shuffle so that each value of ``keys`` goes to at most
    ``files_per_partition`` tasks: hash of the keys plus a salt drawn per
    row (seeded: a task that runs again deals alike). Rows of a key are dealt evenly over that many
    tasks, even if they are all alike (one timestamp, or none)."""
    salt = F.floor(F.rand(0) * int(files_per_partition))
    return df.repartition(*[F.col(k) for k in keys], salt)


def stream_to_table(
    df: DataFrame,
    cfg: TableConfig,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    files_per_partition: int | None = None,
) -> StreamingQuery:
    """Append-mode streaming sink with its own checkpoint.

    Each micro-batch writes its files and commits them with the batch id, so
    a restart after failure neither loses nor repeats a batch in the table.

    By default every input task writes one file per date it holds (no
    shuffle). ``files_per_partition=k`` shuffles each batch so that a date
    gets at most ``k`` files per batch (``spread_by_partition``): fewer,
    larger files when input tasks each span many dates, at the cost of one
    shuffle per batch. Adaptive execution does not run inside micro-batches,
    so this is the bound to use instead of a rebalance.
    """
    if files_per_partition and cfg.partition_by:
        df = spread_by_partition(df, cfg.partition_by, files_per_partition)
    writer = (
        df.writeStream.format(cfg.format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if cfg.partition_by:
        writer = writer.partitionBy(*cfg.partition_by)
    if cfg.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(cfg.max_records_per_file))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(cfg.path)
