"""CSV deliveries whose headers differ: columns by name, or a quarantined file.

The files of a micro-batch are read as lines. The first line of a file is its
header; a file whose header names every column of the schema once is read,
whatever the order of its columns and whatever other columns it has. Any other
file gives no rows: it is in the report with its name, header and reason, and
the stream goes on.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sigflow.operators.ingest import MALFORMED
from sigflow.operators.joins import join_dimension
from sigflow.schemas import RAW_SCHEMA
from sigflow.sources.csv import CSV_GLOB, MAX_FILE_AGE, check_deliveries
from sigflow.sources.table import TableConfig
from sigflow.streaming.batches import BATCH, overwrite_partitions
from sigflow.streaming.dedupe import only_data_batches

#: Columns of the report; ``reason`` is null for a file that was read.
REPORT_SCHEMA = "file string, header string, reason string"


def _lines(reader, path: str, glob: str | None) -> DataFrame:
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.format("text").load(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _names(header: Column) -> Column:
    """The names of a header line, quoted or not; an empty one may follow."""
    parts = F.regexp_extract_all(header, F.lit(r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'), 1)
    return F.transform(parts, lambda p: F.replace(F.regexp_replace(F.trim(p), '^"|"$', ""), F.lit('""'), F.lit('"')))


def headers(lines: DataFrame, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """A row per file with a line that isn't blank: file, header, names,
    reason (null if each column of ``schema`` stands once in the header)."""
    wanted = F.array(*[F.lit(n) for n in schema.names])
    first = lines.filter((F.col("block") == 0) & (F.trim("value") != "")).withColumn("at", F.monotonically_increasing_id())
    found = first.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = found.withColumn("names", _names(F.ltrim(F.col("header"), F.lit("\ufeff"))))
    missing = F.array_except(wanted, "names")
    twice = F.filter(wanted, lambda n: F.size(F.filter(F.col("names"), lambda x: x == n)) > 1)
    reason = F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    reason = reason.when(F.size(twice) > 0, F.concat(F.lit("twice: "), F.array_join(twice, ", ")))
    return found.withColumn("reason", reason)


def rows_by_name(lines: DataFrame, found: DataFrame, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """The rows of the files that can be read: the columns of ``schema``, and
    ``malformed``, the line if a value in it doesn't fit its column.

    ``found``: ``headers`` of these lines. Blank lines and lines equal to the
    file's header are no rows; a field that a line lacks is null. A quoted
    value must not go over a line's end.
    """
    good = found.filter("reason IS NULL").select(
        "file", "header", F.size("names").alias("width"), *[(F.array_position("names", n) - 1).cast("int").alias(f"at{i}") for i, n in enumerate(schema.names)]
    )
    width = good.agg(F.max("width")).first()[0] or len(schema)
    read = join_dimension(lines, good, "file", how="inner").filter((F.col("value") != F.col("header")) & (F.trim("value") != ""))
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)))
    read = read.withColumn("fields", fields).withColumn("fields", F.array(*[F.col("fields")[f"c{i}"] for i in range(width)]))
    texts = [F.get("fields", F.col(f"at{i}")) for i in range(len(schema))]
    values = [t.try_cast(f.dataType) for t, f in zip(texts, schema, strict=True)]
    odd = F.lit(False)
    for t, v in zip(texts, values, strict=True):
        odd = odd | (t.isNotNull() & v.isNull())
    return read.select(*[v.alias(n) for v, n in zip(values, schema.names, strict=True)], F.when(odd, F.col("value")).alias(MALFORMED))


def read_drifting_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, glob: str | None = CSV_GLOB) -> tuple[DataFrame, DataFrame]:
    """Rows and report of a folder, as one batch."""
    check_deliveries(spark, path, glob)
    lines = _lines(spark.read, path, glob)
    found = headers(lines, schema)
    return rows_by_name(lines, found, schema), found.select("file", "header", "reason")


def ingest_drifting_csv(
    spark: SparkSession,
    path: str,
    table: TableConfig,
    report: TableConfig,
    checkpoint: str,
    schema: StructType = RAW_SCHEMA,
    glob: str | None = CSV_GLOB,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append the rows of a folder's files to a raw table, and a row per file
    to the report. A batch that runs again overwrites its own partitions."""
    check_deliveries(spark, path, glob)
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    writer = hashlib.sha1(checkpoint.encode()).hexdigest()[:10]

    def each(lines: DataFrame, batch_id: int) -> None:
        found = headers(lines, schema).persist()
        try:
            name = F.lit(f"{writer}-{batch_id}")
            overwrite_partitions(rows_by_name(lines, found, schema).withColumn(BATCH, name), _by_batch(table))
            overwrite_partitions(found.select("file", "header", "reason").withColumn(BATCH, name), _by_batch(report))
        finally:
            found.unpersist()

    stream = _lines(reader, path, glob).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    stream = stream.trigger(processingTime=processing_time) if processing_time else stream.trigger(availableNow=True)
    with only_data_batches(spark):
        query = stream.start()
    if wait and not processing_time:
        query.awaitTermination()
    return query


def _by_batch(cfg: TableConfig) -> TableConfig:
    return TableConfig(cfg.path, cfg.format, (BATCH,), cfg.max_records_per_file)


def read_drift_table(spark: SparkSession, table: TableConfig, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """The rows that ``ingest_drifting_csv`` wrote; none if all files are quarantined."""
    return spark.read.format(table.format).schema(StructType(list(schema.fields)).add(MALFORMED, "string").add(BATCH, "string")).load(table.path)


def read_drift_report(spark: SparkSession, report: TableConfig) -> DataFrame:
    """A row per file: file, header, reason (null: its rows are in the table)."""
    return spark.read.format(report.format).schema(f"{REPORT_SCHEMA}, {BATCH} string").load(report.path)
