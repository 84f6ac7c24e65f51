"""Idempotent batches, the ledger, quarantined texts, one-pass de-duplication."""

import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sigflow.operators.ingest import decode_telemetry
from sigflow.sources.table import TableConfig
from sigflow.sources.topic import TopicConfig
from sigflow.streaming import ingest_batches, ingest_topic, read_batches, read_ledger, read_quarantine

GOOD = '{"Date/Time":"01 01 2024 00:%02d","LV ActivePower (kW)":%d}'
BAD = ["", "not json", '{"Date/Time":"01 01 2024 00:00"', '{"Date/Time":"40 01 2024 00:00"}', '{"Wind Speed (m/s)":1}', '{"Date/Time":"01 01 2024 00:05","Wind Speed (m/s)":"calm"}', "7"]


def deliver(folder, name, lines, at=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (at or time.time(),) * 2)


class Place:
    def __init__(self, spark, folder, per_batch=1):
        self.spark = spark
        self.inbox = os.path.join(folder, "topic")
        self.topic = TopicConfig(path=self.inbox, max_files_per_trigger=per_batch)
        self.table, self.quarantine = (TableConfig(path=os.path.join(folder, n)) for n in ("table", "quarantine"))
        self.ledger, self.checkpoint = (os.path.join(folder, n) for n in ("ledger", "checkpoint"))

    def ingest(self, **more):
        return ingest_batches(self.spark, self.topic, self.table, self.ledger, self.checkpoint, self.quarantine, **more)

    def rows(self):
        got = read_batches(self.spark, self.table).select("signal_ts", F.to_json("signals").alias("s"), "malformed").collect()
        return sorted((str(r.signal_ts), r.s, r.malformed) for r in got)


@pytest.fixture()
def place(spark, scratch):
    return Place(spark, scratch)


def test_malformed_texts_are_kept_once_and_counted(place):
    deliver(place.inbox, "a", [GOOD % (1, 5), *BAD], 1e9)
    deliver(place.inbox, "b", [GOOD % (2, 6)], 2e9)
    place.ingest()
    assert len(place.rows()) == 2 + len(BAD)
    assert sorted(r.malformed for r in read_quarantine(place.spark, place.quarantine).collect()) == sorted(BAD)
    ledger = [tuple(r) for r in read_ledger(place.spark, place.ledger).orderBy("batch_id").select("rows_written", "rows_malformed", "rows_untimed").collect()]
    assert ledger == [(1 + len(BAD), len(BAD), len(BAD) - 1), (1, 0, 0)]


def test_good_messages_have_no_text(spark):
    rows = decode_telemetry(spark.createDataFrame([(GOOD % (3, 1),), ('{"Date/Time":"01 01 2024 00:07","more":[1]}',), (None,)], "value string"))
    got = {str(r.signal_ts): r.malformed for r in rows.collect()}
    assert got == {"2024-01-01 00:03:00": None, "2024-01-01 00:07:00": None, "None": None}


@pytest.mark.parametrize("stopped", [0, 1, 2])
def test_stopped_batch_leaves_equal_rows(place, stopped):
    for i in range(3):
        deliver(place.inbox, f"f{i}", [GOOD % (i, i), GOOD % (i, i), BAD[1]], 1e9 + i)

    def stop(batch_id):
        if batch_id == stopped:
            raise RuntimeError("stopped")

    with pytest.raises(StreamingQueryException):
        place.ingest(after_write=stop)
    written = place.rows()
    assert len(written) == 3 * (stopped + 1)
    assert read_ledger(place.spark, place.ledger).count() == stopped if stopped else not os.path.exists(place.ledger)
    place.ingest()
    assert len(place.rows()) == 9
    assert place.rows()[:1] and read_quarantine(place.spark, place.quarantine).count() == 3
    assert read_ledger(place.spark, place.ledger).count() == 3
    place.ingest()  # nothing new
    assert len(place.rows()) == 9


def test_recorded_batch_is_not_written_again(place):
    from sigflow.streaming.batches import write_batch

    rows = decode_telemetry(place.spark.createDataFrame([(GOOD % (1, 1),)], "value string"))
    seen = []
    for _ in range(2):
        write_batch(rows, 7, place.table, place.ledger, "w", place.quarantine, seen.append)
    assert seen == [7] and len(place.rows()) == 1
    # Another writer's batch of the same number is another batch.
    write_batch(rows, 7, place.table, place.ledger, "v", place.quarantine)
    assert len(place.rows()) == 2


def test_hot_date_is_split_inside_a_batch(spark, place):
    deliver(place.inbox, "seed", [GOOD % (0, 0)])
    rows = spark.range(60_000, numPartitions=12).select(F.format_string('{"Date/Time":"01 01 2024 00:%02d","LV ActivePower (kW)":%d}', F.col("id") % 60, F.col("id")).alias("value"))
    rows.write.mode("append").text(place.inbox)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        Place.ingest(Place(spark, os.path.dirname(place.inbox), per_batch=100))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for d, _, names in os.walk(os.path.join(place.table.path, "signal_date=2024-01-01")) for f in names if f.endswith(".parquet")]
    assert len(files) > 1
    assert len(place.rows()) == 60_001


def progress_rows(query):
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_repeats_go_in_one_pass_and_no_reading_is_lost(spark, scratch):
    topic = TopicConfig(path=os.path.join(scratch, "topic"), max_files_per_trigger=1)
    table = TableConfig(path=os.path.join(scratch, "table"))
    first = [GOOD % (i, i) for i in range(10)] + [GOOD % (3, 99), BAD[1], BAD[2], BAD[1]]
    late = ['{"Date/Time":"01 01 2020 00:00","LV ActivePower (kW)":1}']
    deliver(topic.path, "a", first, 1e9)
    deliver(topic.path, "b", first + ['{"Date/Time":"09 01 2024 00:00","LV ActivePower (kW)":1}'], 1e9 + 1)
    deliver(topic.path, "c", late, 1e9 + 2)  # far behind the watermark

    def ingest():
        return ingest_topic(spark, topic, table, os.path.join(scratch, "ck"), dedupe_within="1 hour")

    query = ingest()
    assert progress_rows(query) == 2 * len(first) + 2  # each message read once
    got = spark.read.parquet(table.path)
    assert got.filter("signal_ts IS NOT NULL").count() == 11 + 1 + 1
    assert got.filter("signal_ts IS NULL").count() == 2
    # A restart knows what came before: the text again within the delay, and
    # a reading whose stretch the watermark has not passed.
    deliver(topic.path, "d", [BAD[1], '{"Date/Time":"09 01 2024 00:00","LV ActivePower (kW)":1}', "new text"], 1e9 + 3)
    ingest()
    assert spark.read.parquet(table.path).count() == 15 + 1
