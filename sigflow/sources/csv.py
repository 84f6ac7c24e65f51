"""Delimited-file sources: batch scan and streaming directory source."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sigflow.schemas import RAW_SCHEMA
from sigflow.session import file_paths


#: Deliveries: ``.csv`` in any letter case, plain or compressed, and part files
#: without an extension. Pass ``glob=None`` to read every file.
CSV_GLOB = "{*.[cC][sS][vV],*.[cC][sS][vV].gz,*.[cC][sS][vV].bz2,*.[cC][sS][vV].zst,*.[cC][sS][vV].lz4,*.[cC][sS][vV].snappy,*.[cC][sS][vV].deflate,part-[0-9][0-9][0-9][0-9][0-9],part-[mr]-[0-9][0-9][0-9][0-9][0-9]}"

#: Names that are no deliveries and are left out without a word: hidden files,
#: markers, notes, checksums and what an upload or an archive leaves. Any other name that the
#: glob does not take is an error.
NO_DELIVERY = r"[._].*|.*\.(old|bak|tmp|crc|part|filepart|_COPYING_|txt|md|log|md5|sha1|sha256)"

#: A stream takes a file whatever its age: backfills and copies keep their
#: old modification time. The list of files already read is kept in full.
MAX_FILE_AGE = "36500d"


def check_deliveries(spark: SparkSession, path: str, glob: str | None = CSV_GLOB) -> None:
    """Raise if a file below ``path`` is neither taken by ``glob`` nor on the
    list of names that are no deliveries, so that none is skipped in silence
    (a codec's suffix that Spark doesn't know, say)."""
    if not glob:
        return
    wanted = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobFilter(glob)
    left = [p for p in file_paths(spark, path) if not re.fullmatch(NO_DELIVERY, p.getName()) and not wanted.accept(p)]
    if left:
        names = ", ".join(sorted(p.toString() for p in left)[:20])
        raise ValueError(f"{len(left)} files are no deliveries by their names: {names}; rename them or pass another glob")


def _csv_options(reader, glob: str | None):
    reader = reader.option("header", True).option("enforceSchema", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = RAW_SCHEMA,
    infer_schema: bool = False,
    glob: str | None = CSV_GLOB,
    malformed: str | None = None,
) -> DataFrame:
    """Batch CSV scan with a header row. With ``malformed`` (and a fixed
    schema) a column of that name has the line of each row that doesn't fit.

    A fixed schema is the default: inference costs an extra pass over all of
    the data.
    ``enforceSchema=false`` checks the header against the schema, so a file
    whose columns are in another order fails instead of being misread.
    """
    check_deliveries(spark, path, glob)
    reader = _csv_options(spark.read, glob)
    if malformed and schema is not None:
        schema = StructType(list(schema.fields)).add(malformed, "string")
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    if infer_schema:
        reader = reader.option("inferSchema", True)
    elif schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def stream_raw_csv(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_SCHEMA,
    glob: str | None = CSV_GLOB,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded CSV directory source; a stream always needs a fixed schema
    (pass ``read_raw_csv(..., infer_schema=True).schema`` to reuse an
    inferred one). Names are checked for the files that are there at the
    start."""
    check_deliveries(spark, path, glob)
    reader = _csv_options(spark.readStream, glob).schema(schema).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.csv(path)
