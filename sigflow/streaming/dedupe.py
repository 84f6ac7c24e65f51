"""Dropping repeated readings from a stream, in one pass over each batch.

Delivery is at least once: a reading (same time, same values) may come again.
One keyed stateful operator holds the digests of what came. Its keys are a
stretch of event time and a slot of the digest, so a busy stretch is spread
over tasks and a key's state ends as a whole. It has two kinds of expiry:

* timed rows: a stretch ends when the watermark has passed it by the delay;
* untimed rows (their time did not parse) share no reading time: a text is
  known for the delay after it first came, in processing time.

A reading that is older than the watermark is never lost: if its stretch has
ended, it counts as new.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from sigflow.operators.ingest import MALFORMED

#: Slots per stretch of event time.
SLOTS = 4
_DIGEST = "digest"
_STRETCH, _SLOT = "stretch", "slot"
_STATE = "digests binary, seen binary"
_MAP = "map<string,string>"


def _milliseconds(delay: str) -> int:
    """A delay such as "1 hour" or "90 seconds"."""
    return int(pd.Timedelta(delay) / pd.Timedelta("1ms"))


@contextmanager
def only_data_batches(spark: SparkSession) -> Iterator[None]:
    """A query started inside runs no batches without data. An operator with
    processing-time expiry asks for one after every batch, so a query that
    is to stop at the end of its input never would; expired state goes with
    the next data instead."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drop_repeats(rows: DataFrame, within: str, slots: int = SLOTS) -> DataFrame:
    """Telemetry rows (with the column ``malformed``) without repeats that
    come within the delay ``within`` of each other.

    Timed rows repeat when time, values and the text of a damaged message are
    equal, untimed ones when their text is; untimed rows without a text are all kept. Which of several equal
    rows stays is not determined; ingest columns are the kept row's.
    """
    delay = _milliseconds(within)
    names = rows.columns
    signals = F.to_json("signals", {"ignoreNullFields": "false"})
    timed = F.col("signal_ts").isNotNull()
    reading = F.when(timed, F.concat_ws("|", F.lit("t"), F.unix_micros("signal_ts"), "signals", MALFORMED)).otherwise(F.concat_ws("|", F.lit("u"), F.col(MALFORMED)))
    flat = rows.withWatermark("signal_ts", within).withColumn("signals", signals).withColumn(_DIGEST, F.unhex(F.md5(reading)))
    flat = flat.withColumn(_STRETCH, F.floor(F.unix_millis("signal_ts") / delay)).withColumn(_SLOT, F.pmod(F.xxhash64(_DIGEST), F.lit(slots)).cast("int"))
    schema = StructType([f for f in flat.schema if f.name in names])

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stretch = key[0]
        untimed = stretch is None or pd.isna(stretch)
        now, watermark = state.getCurrentProcessingTimeMs(), state.getCurrentWatermarkMs()
        known: dict[bytes, int] = {}
        if state.exists:
            digests, seen = state.get
            known = dict(zip((digests[i : i + 16] for i in range(0, len(digests), 16)), np.frombuffer(seen, np.int64).tolist(), strict=True))
        if untimed:
            known = {d: t for d, t in known.items() if t + delay > now}
        elif state.hasTimedOut and watermark > (stretch + 2) * delay:
            known = {}
        if not state.hasTimedOut:
            for pdf in batches:
                new = []
                for digest, text in zip(pdf[_DIGEST], pdf[MALFORMED], strict=True):
                    fresh = digest not in known
                    new.append(fresh or (untimed and text is None))
                    if fresh:
                        known[digest] = now
                yield pdf.loc[new, names]
        if known:
            state.update((b"".join(known), np.fromiter(known.values(), np.int64, len(known)).tobytes()))
            state.setTimeoutDuration(delay)
        else:
            state.remove()

    kept = flat.groupBy(_STRETCH, _SLOT).applyInPandasWithState(run, schema, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
    return kept.withColumn("signals", F.from_json("signals", _MAP)).select(*names)
