"""K6: every stage's output against its schema constant."""

from conftest import SF001
from sigflow.operators.analysis import hourly_generation, rename_signals, to_long
from sigflow.operators.ingest import decode_messages, encode_messages, shape_telemetry
from sigflow.operators.model import assemble, power_features, predict_day, train_and_evaluate
from sigflow.plans.staging import load_telemetry
from sigflow.schemas import (
    FEATURES_SCHEMA,
    HOURLY_SCHEMA,
    LONG_SCHEMA,
    MAPPING_SCHEMA,
    PREDICTION_SCHEMA,
    RAW_SCHEMA,
    TELEMETRY_SCHEMA,
    TOPIC_SCHEMA,
    same_fields,
)
from sigflow.sources.mapping import mapping_frame, mapping_from_json
from sigflow.sources.testdata import events_raw, events_telemetry, read_events


def test_stage_schemas(spark):
    events = read_events(spark, SF001)
    raw = events_raw(events)
    assert same_fields(raw.schema, RAW_SCHEMA)
    messages = encode_messages(raw)
    assert same_fields(messages.schema, TOPIC_SCHEMA)
    decoded = decode_messages(messages)
    assert same_fields(decoded.schema, RAW_SCHEMA)
    assert same_fields(shape_telemetry(decoded).schema, TELEMETRY_SCHEMA)
    assert same_fields(events_telemetry(events).schema, TELEMETRY_SCHEMA, any_timestamp=True)
    telemetry = load_telemetry(spark, SF001)
    hourly = hourly_generation(telemetry)
    assert same_fields(hourly.schema, HOURLY_SCHEMA)
    assert same_fields(mapping_frame(spark).schema, MAPPING_SCHEMA)
    assert same_fields(mapping_from_json(spark).schema, MAPPING_SCHEMA)
    assert same_fields(rename_signals(to_long(hourly), mapping_frame(spark)).schema, LONG_SCHEMA)
    features = power_features(telemetry)
    assert same_fields(assemble(features).schema, FEATURES_SCHEMA, any_timestamp=True)
    run = train_and_evaluate(telemetry)
    day = predict_day(run.model, features, "2024-01-15")
    assert same_fields(day.schema, PREDICTION_SCHEMA, any_timestamp=True)
    assert not same_fields(day.schema, PREDICTION_SCHEMA)  # the table keeps time-zone-free time
