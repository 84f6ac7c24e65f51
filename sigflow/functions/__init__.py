"""Column expressions: signal lookup and packing, parsing, bands, averages."""

from sigflow.functions.bands import band, generation_indicator
from sigflow.functions.signals import (
    decode_json,
    message_value,
    parse_signal_ts,
    quoted,
    signal_value,
    signals_map,
)
from sigflow.functions.stats import slot_bitmap

__all__ = [
    "band",
    "decode_json",
    "slot_bitmap",
    "generation_indicator",
    "message_value",
    "parse_signal_ts",
    "quoted",
    "signal_value",
    "signals_map",
]
