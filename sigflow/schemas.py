"""Data model of the telemetry pipeline: fixed names, fixed values, schemas.


RAW_SCHEMA        D1  one CSV row per 10-minute reading
TOPIC_SCHEMA      D2  topic record: one JSON text per message
MESSAGE_SCHEMA    D3  decoded topic message (RAW plus an optional row_id)
TELEMETRY_SCHEMA  D4  ingested table, signals held in map<string,string>
HOURLY_SCHEMA     D5  hourly averages with the generation band
MAPPING_SCHEMA    D6  signal-name dimension
LONG_SCHEMA       D7  one row per (date, hour, signal)
FEATURES_SCHEMA   D8  assembled model rows (features vector)
PREDICTION_SCHEMA D9  scored rows
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --------------------------------------------------------------------------
# Fixed values. These are the names and numbers the data and the task use;
# they must stay exactly as written (the degree sign is U+00B0).
# --------------------------------------------------------------------------
DATE_TIME = "Date/Time"
ACTIVE_POWER = "LV ActivePower (kW)"
WIND_SPEED = "Wind Speed (m/s)"
THEORETICAL_POWER = "Theoretical_Power_Curve (KWh)"
WIND_DIRECTION = "Wind Direction (°)"

SIGNAL_KEYS = (ACTIVE_POWER, WIND_SPEED, THEORETICAL_POWER, WIND_DIRECTION)

# Text layout of the Date/Time column.
TIMESTAMP_FORMAT = "dd MM yyyy HH:mm"

# Signal name -> mapped name, as the analysis code defines it.
SIGNAL_MAPPING = (
    (ACTIVE_POWER, "active_power_average"),
    (WIND_SPEED, "wind_speed_average"),
    (THEORETICAL_POWER, "theo_power_curve_average"),
    (WIND_DIRECTION, "wind_direction_average"),
)

# The same mapping as the task text gives it: a JSON array in which the
# theoretical-power entry appears twice.
SIGNAL_MAPPING_JSON = """[
    {"sig_name": "LV ActivePower (kW)", "sig_mapping_name": "active_power_average"},
    {"sig_name": "Wind Speed (m/s)", "sig_mapping_name": "wind_speed_average"},
    {"sig_name": "Theoretical_Power_Curve (KWh)", "sig_mapping_name": "theo_power_curve_average"},
    {"sig_name": "Theoretical_Power_Curve (KWh)", "sig_mapping_name": "theo_power_curve_average"},
    {"sig_name": "Wind Direction (°)", "sig_mapping_name": "wind_direction_average"}
]"""

# Generation bands on the hourly average active power (kW): upper bounds
# (exclusive) of Low, Medium and High; everything else is Exceptional.
BAND_BOUNDS = (200.0, 600.0, 1000.0)
BAND_LABELS = ("Low", "Medium", "High", "Exceptional")

# 10-minute cadence.
EXPECTED_PER_HOUR = 6
EXPECTED_PER_DAY = 144
# --------------------------------------------------------------------------

# Hourly average column per signal, in SIGNAL_KEYS order.
AVG_COLUMNS = (
    "avg_active_power",
    "avg_wind_speed",
    "avg_theoretical_power_curve",
    "avg_wind_direction",
)

# Typed per-row columns used by the model, in SIGNAL_KEYS order.
TYPED_COLUMNS = ("active_power", "wind_speed", "theoretical_curve", "wind_direction")
LABEL_COLUMN = "active_power"
FEATURE_COLUMNS = ("wind_speed", "theoretical_curve", "wind_direction")

RAW_SCHEMA = StructType(
    [
        StructField(DATE_TIME, StringType(), True),
        StructField(ACTIVE_POWER, DoubleType(), True),
        StructField(WIND_SPEED, DoubleType(), True),
        StructField(THEORETICAL_POWER, DoubleType(), True),
        StructField(WIND_DIRECTION, DoubleType(), True),
    ]
)

TOPIC_SCHEMA = StructType([StructField("value", StringType(), True)])

MESSAGE_SCHEMA = StructType(RAW_SCHEMA.fields + [StructField("row_id", LongType(), True)])

TELEMETRY_SCHEMA = StructType(
    [
        StructField("signal_date", DateType(), True),
        StructField("signal_ts", TimestampType(), True),
        StructField("create_date", DateType(), False),
        StructField("create_ts", TimestampType(), False),
        StructField("signals", MapType(StringType(), StringType(), True), False),
    ]
)

HOURLY_SCHEMA = StructType(
    [
        StructField("signal_date", DateType(), True),
        StructField("hour_of_day", IntegerType(), True),
    ]
    + [StructField(c, DoubleType(), True) for c in AVG_COLUMNS]
    + [StructField("generation_indicator", StringType(), False)]
)

MAPPING_SCHEMA = StructType(
    [
        StructField("sig_name", StringType(), True),
        StructField("sig_mapping_name", StringType(), True),
    ]
)

LONG_SCHEMA = StructType(
    [
        StructField("signal_date", DateType(), True),
        StructField("hour_of_day", IntegerType(), True),
        StructField("generation_indicator", StringType(), False),
        StructField("sig_name", StringType(), False),
        StructField("sig_mapping_name", StringType(), True),
        StructField("value", DoubleType(), True),
    ]
)

FEATURES_SCHEMA = StructType(
    [
        StructField("signal_date", DateType(), True),
        StructField("signal_ts", TimestampType(), True),
        StructField("features", VectorUDT(), True),
        StructField("active_power", DoubleType(), True),
    ]
)

PREDICTION_SCHEMA = StructType(
    [
        StructField("signal_date", DateType(), True),
        StructField("signal_ts", TimestampType(), True),
        StructField("active_power", DoubleType(), True),
        StructField("prediction", DoubleType(), True),
    ]
)


def same_fields(
    actual: StructType, expected: StructType, check_nullable: bool = False, any_timestamp: bool = False
) -> bool:
    """Schema report (printSchema) turned into a check: names and types in
    order. ``any_timestamp`` accepts ``timestamp_ntz`` where ``timestamp`` is
    expected (tables built from time-zone-free sources)."""
    if len(actual.fields) != len(expected.fields):
        return False
    for a, e in zip(actual.fields, expected.fields):
        a_type, e_type = a.dataType.simpleString(), e.dataType.simpleString()
        if any_timestamp and {a_type, e_type} == {"timestamp", "timestamp_ntz"}:
            a_type = e_type
        if a.name != e.name or a_type != e_type:
            return False
        if check_nullable and a.nullable != e.nullable:
            return False
    return True
