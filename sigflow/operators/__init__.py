"""DataFrame -> DataFrame operators of the pipeline."""

from sigflow.operators.analysis import (
    daily_datapoints,
    daily_from_bitmaps,
    daily_from_hourly,
    hourly_averages,
    hourly_datapoints,
    hourly_from_bitmaps,
    hourly_generation,
    minute_bitmaps,
    rename_signals,
    slots_seen,
    to_long,
    with_generation_indicator,
)
from sigflow.operators.ingest import decode_messages, decode_telemetry, encode_messages, quarantine_split, shape_telemetry
from sigflow.operators.joins import join_dimension
from sigflow.operators.model import (
    actual_vs_predicted,
    assemble,
    chart_bounds,
    hash_split,
    load_model,
    power_features,
    predict_day,
    random_split,
    regression_metrics,
    save_model,
    score,
    train_and_evaluate,
    train_pipeline,
    train_power_model,
)
from sigflow.operators.preview import preview

__all__ = [
    "actual_vs_predicted",
    "assemble",
    "chart_bounds",
    "daily_datapoints",
    "daily_from_bitmaps",
    "daily_from_hourly",
    "decode_messages",
    "decode_telemetry",
    "encode_messages",
    "hash_split",
    "hourly_averages",
    "hourly_datapoints",
    "hourly_from_bitmaps",
    "hourly_generation",
    "join_dimension",
    "load_model",
    "minute_bitmaps",
    "power_features",
    "predict_day",
    "preview",
    "quarantine_split",
    "random_split",
    "regression_metrics",
    "rename_signals",
    "save_model",
    "score",
    "shape_telemetry",
    "slots_seen",
    "to_long",
    "train_and_evaluate",
    "train_pipeline",
    "train_power_model",
    "with_generation_indicator",
]
