import os

from pyspark.sql import functions as F

from sigflow.operators.ingest import decode_messages, encode_messages, shape_telemetry
from sigflow.sources.table import TableConfig, read_table
from sigflow.sources.testdata import events_raw, read_events
from sigflow.sources.topic import TopicConfig, read_topic
from sigflow.streaming import ingest_topic, publish_csv

from conftest import SF001


def _stage_csv(spark, events, folder):
    events_raw(events).coalesce(1).write.option("header", True).csv(folder)


def test_restart_and_incremental_delivery(spark, scratch):
    events = read_events(spark, SF001)
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    inbox = os.path.join(scratch, "inbox")
    topic = TopicConfig(path=os.path.join(scratch, "topic"))
    table = TableConfig(path=os.path.join(scratch, "table"))

    def deliver(rows):
        events_raw(rows).write.mode("append").option("header", True).csv(inbox)

    def cycle():
        publish_csv(spark, inbox, topic, os.path.join(scratch, "ck-producer"))
        ingest_topic(spark, topic, table, os.path.join(scratch, "ck-subscriber"))
        return read_table(spark, table).count()

    n_first = events.filter(~late).count()
    deliver(events.filter(~late))
    assert cycle() == n_first
    assert cycle() == n_first  # restart with nothing new adds nothing
    deliver(events.filter(late))
    assert cycle() == events.count()  # only the new files' rows are added
    # the table is partitioned by date
    assert any(p.startswith("signal_date=") for p in os.listdir(table.path))


def test_long_running_trigger(spark, scratch):
    folder = os.path.join(scratch, "csv")
    events = read_events(spark, SF001)
    _stage_csv(spark, events, folder)
    topic = TopicConfig(path=os.path.join(scratch, "topic"))
    q = publish_csv(spark, folder, topic, os.path.join(scratch, "ck"), available_now=False,
                    processing_time="1 second", wait=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_topic(spark, topic, streaming=False).count() == events.count()


def test_stream_equals_batch(spark, scratch):
    events = read_events(spark, SF001)
    folder = os.path.join(scratch, "csv")
    _stage_csv(spark, events, folder)
    topic = TopicConfig(path=os.path.join(scratch, "topic"))
    table = TableConfig(path=os.path.join(scratch, "table"))
    publish_csv(spark, folder, topic, os.path.join(scratch, "ck1"), max_files_per_trigger=1)
    ingest_topic(spark, topic, table, os.path.join(scratch, "ck2"))
    streamed = read_table(spark, table).select("signal_ts", F.col("signals").cast("string").alias("s"))
    batch = shape_telemetry(decode_messages(encode_messages(events_raw(events)))).select(
        "signal_ts", F.col("signals").cast("string").alias("s")
    )
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # the topic holds one message per row
    assert read_topic(spark, topic, streaming=False).count() == events.count()


def test_dedupe_within_watermark_option(spark, scratch):
    msgs = [
        '{"Date/Time":"01 01 2018 00:00","LV ActivePower (kW)":1.0}',
        '{"Date/Time":"01 01 2018 00:00","LV ActivePower (kW)":1.0}',
        '{"Date/Time":"01 01 2018 00:10","LV ActivePower (kW)":2.0}',
        "{bad",
        '{"Date/Time":"xx","LV ActivePower (kW)":3.0}',
    ]
    topic_dir = os.path.join(scratch, "topic")
    os.makedirs(topic_dir)
    with open(os.path.join(topic_dir, "m.txt"), "w") as fh:
        fh.write("\n".join(msgs) + "\n")
    table = TableConfig(path=os.path.join(scratch, "table"))
    ingest_topic(spark, TopicConfig(path=topic_dir), table, os.path.join(scratch, "ck"), dedupe_within="1 hour")
    out = read_table(spark, table)
    assert out.filter("signal_ts is not null").count() == 2  # the repeated reading is dropped
    assert out.filter("signal_ts is null").count() == 2  # malformed rows are all kept


def test_files_per_partition_bounds_files(spark, scratch):
    events = read_events(spark, SF001)
    folder = os.path.join(scratch, "csv")
    events_raw(events).repartition(4).write.option("header", True).csv(folder)
    topic = TopicConfig(path=os.path.join(scratch, "topic"))
    publish_csv(spark, folder, topic, os.path.join(scratch, "ck1"))
    table = TableConfig(path=os.path.join(scratch, "table"))
    ingest_topic(spark, topic, table, os.path.join(scratch, "ck2"), files_per_partition=1)
    for d in os.listdir(table.path):
        if d.startswith("signal_date="):
            assert len([f for f in os.listdir(os.path.join(table.path, d)) if f.endswith(".parquet")]) == 1
    assert read_table(spark, table).count() == events.count()


def test_stream_skips_stray_file_and_reads_bom_crlf(spark, scratch):
    header = "Date/Time,LV ActivePower (kW),Wind Speed (m/s),Theoretical_Power_Curve (KWh),Wind Direction (°)"
    folder = os.path.join(scratch, "data")
    os.makedirs(os.path.join(folder, "nested"))
    with open(os.path.join(folder, "x.csv"), "w", encoding="utf-8-sig", newline="") as fh:
        fh.write(f"{header}\r\n01 01 2018 00:00,1.5,2,3,4\r\n01 01 2018 00:10,2.5,2,3,4\r\n")
    with open(os.path.join(folder, "x.csv.old"), "w", encoding="utf-8") as fh:
        fh.write(f"{header}\n01 01 2018 00:20,9,9,9,9\n")
    with open(os.path.join(folder, "nested", "y.csv"), "w", encoding="utf-8") as fh:
        fh.write(f"{header}\n01 01 2018 00:30,9,9,9,9\n")
    topic = TopicConfig(path=os.path.join(scratch, "topic"))
    publish_csv(spark, folder, topic, os.path.join(scratch, "ck"))
    rows = decode_messages(read_topic(spark, topic, streaming=False)).orderBy("Date/Time").collect()
    assert [r["Date/Time"] for r in rows] == ["01 01 2018 00:00", "01 01 2018 00:10"]
    assert rows[0]["LV ActivePower (kW)"] == 1.5


def test_stream_fails_on_swapped_header(spark, scratch):
    import pytest

    folder = os.path.join(scratch, "data")
    os.makedirs(folder)
    swapped = "Date/Time,Wind Speed (m/s),LV ActivePower (kW),Theoretical_Power_Curve (KWh),Wind Direction (°)"
    with open(os.path.join(folder, "x.csv"), "w", encoding="utf-8") as fh:
        fh.write(f"{swapped}\n01 01 2018 00:00,1,2,3,4\n")
    topic = TopicConfig(path=os.path.join(scratch, "topic"))
    with pytest.raises(Exception):
        publish_csv(spark, folder, topic, os.path.join(scratch, "ck"))
