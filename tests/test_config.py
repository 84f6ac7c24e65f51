import pytest

from sigflow.sources.table import TableConfig
from sigflow.sources.topic import TopicConfig


def test_topic_config_validation():
    assert TopicConfig(path="/x").kind == "files"
    kafka = TopicConfig(kind="kafka", bootstrap_servers="h:9092", topic="t")
    assert kafka.starting_offsets == "earliest" and kafka.fail_on_data_loss is False
    with pytest.raises(ValueError):
        TopicConfig()  # a file topic needs a path
    with pytest.raises(ValueError):
        TopicConfig(kind="kafka", topic="t")  # no servers
    with pytest.raises(ValueError):
        TopicConfig(kind="queue", path="/x")


def test_table_config_defaults():
    cfg = TableConfig(path="/t")
    assert cfg.format == "parquet" and tuple(cfg.partition_by) == ("signal_date",)


def test_apps_parser_defaults():
    from sigflow.apps import parser

    a = parser().parse_args(["predict", "--table", "/t", "--out", "/o", "--day", "2024-01-15"])
    assert a.engine == "moments" and a.split == "hash" and a.split_hash == "xxhash64"
    b = parser().parse_args(["subscribe", "--topic-path", "/p", "--table", "/t", "--checkpoint", "/c"])
    assert b.files_per_date is None and b.table_format == "parquet"


def test_subscribe_batch_bound_reaches_topic_config():
    from sigflow.apps import _topic, parser

    a = parser().parse_args(["subscribe", "--topic-path", "/p", "--table", "/t", "--checkpoint", "/c",
                             "--max-per-trigger", "3"])
    assert _topic(a).max_files_per_trigger == 3
    k = parser().parse_args(["subscribe", "--kafka-servers", "h:9092", "--topic", "t", "--table", "/t",
                             "--checkpoint", "/c", "--max-per-trigger", "1000"])
    assert _topic(k).kind == "kafka" and _topic(k).max_offsets_per_trigger == 1000
