"""Structured Streaming queries: CSV -> topic, topic -> table."""

from sigflow.streaming.batches import ingest_batches, read_batches, read_ledger, read_quarantine
from sigflow.streaming.dedupe import drop_repeats
from sigflow.streaming.drift import ingest_drifting_csv, read_drift_report, read_drift_table, read_drifting_csv
from sigflow.streaming.producer import publish_csv
from sigflow.streaming.subscriber import ingest_topic, telemetry_stream

__all__ = [
    "drop_repeats",
    "ingest_batches",
    "ingest_drifting_csv",
    "ingest_topic",
    "publish_csv",
    "read_batches",
    "read_drift_report",
    "read_drift_table",
    "read_drifting_csv",
    "read_ledger",
    "read_quarantine",
    "telemetry_stream",
]
