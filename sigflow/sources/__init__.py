"""Sources and sinks: CSV files, message topic, telemetry table, mapping."""

from sigflow.sources.csv import read_raw_csv, stream_raw_csv
from sigflow.sources.mapping import mapping_frame, mapping_from_json, unique_mapping
from sigflow.sources.table import TableConfig, read_table, stream_to_table, write_table
from sigflow.sources.topic import TopicConfig, read_topic, write_topic

__all__ = [
    "TableConfig",
    "TopicConfig",
    "mapping_frame",
    "mapping_from_json",
    "read_raw_csv",
    "read_table",
    "read_topic",
    "stream_raw_csv",
    "stream_to_table",
    "unique_mapping",
    "write_table",
    "write_topic",
]
