"""Helpers shared by the operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.session import new_scratch_dir

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it,
    and send them texts in batches that stay small.

    The first only matters when the folder is on the driver's ``sys.path``
    but not on PYTHONPATH. A cluster has the package installed or gets it by
    ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *known])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared scratch folder and read it
    back: the lineage is cut, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = new_scratch_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"{stem}_{uuid.uuid4().hex[:8]}"
    return name


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


#: Rows and bytes of a batch that are Python objects at a time; a longer row
#: is a batch of its own.
ROWS = 500
BATCH_BYTES = 8 << 20


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in batches of ROWS rows and BATCH_BYTES at most."""
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            waiting = [b.slice(i, ROWS)]
            while waiting:
                part = waiting.pop()
                if part.num_rows > 1 and part.nbytes > BATCH_BYTES:
                    half = part.num_rows // 2
                    waiting += [part.slice(half), part.slice(0, half)]
                else:
                    yield part


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over batches, small ones (``small_batches``), given and
    returned as dicts of lists."""
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(p.to_pydict() for p in small_batches(batches)):
            yield pa.RecordBatch.from_pydict(cols, schema=out)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def chunks_by_size(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``most`` characters each;
    a longer text is a range of its own."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


_STATE: dict[str, object] = {}


def worker_state(key: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps across its tasks, until another
    operator's takes its place."""
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make()
    return _STATE[key]
