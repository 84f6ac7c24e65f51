import os

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_CSV
from sigflow.operators.analysis import (
    daily_datapoints,
    daily_from_hourly,
    hourly_datapoints,
    hourly_averages,
    hourly_generation,
    rename_signals,
    to_long,
)
from sigflow.operators.ingest import decode_messages, encode_messages, shape_telemetry
from sigflow.schemas import ACTIVE_POWER, LONG_SCHEMA, SIGNAL_KEYS, WIND_DIRECTION, WIND_SPEED, same_fields
from sigflow.sources.csv import read_raw_csv
from sigflow.sources.mapping import mapping_frame, mapping_from_json


def telemetry(spark, rows):
    """rows: (timestamp text or None, {signal: text})."""
    data = [(ts, sig) for ts, sig in rows]
    df = spark.createDataFrame(data, "t string, signals map<string,string>")
    return df.select(
        F.to_date(F.to_timestamp("t")).alias("signal_date"),
        F.to_timestamp("t").alias("signal_ts"),
        F.current_date().alias("create_date"),
        F.current_timestamp().alias("create_ts"),
        "signals",
    )


def full(v):
    return {k: str(v) for k in SIGNAL_KEYS}


def test_daily_datapoints_distinct_and_completeness(spark):
    rows = [("2024-01-01 00:00:00", full(1)), ("2024-01-01 00:00:00", full(1)),
            ("2024-01-01 00:10:00", full(1)), ("2024-01-02 00:00:00", full(1)), (None, full(1))]
    out = {r.signal_date and str(r.signal_date): r for r in daily_datapoints(telemetry(spark, rows)).collect()}
    assert out["2024-01-01"].distinct_ts_count == 2
    assert out["2024-01-01"].missing_count == 142 and out["2024-01-01"].is_complete is False
    assert out["2024-01-02"].distinct_ts_count == 1
    assert out[None].distinct_ts_count == 0


def test_daily_from_hourly_equals_daily(spark):
    rows = [("2024-01-01 00:00:00", full(1)), ("2024-01-01 00:00:00", full(1)), ("2024-01-01 05:10:00", full(1)),
            ("2024-01-02 23:50:00", full(1)), (None, full(1))]
    t = telemetry(spark, rows)
    a = daily_datapoints(t)
    b = daily_from_hourly(hourly_datapoints(t))
    assert a.schema == b.schema
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hourly_datapoints(spark):
    rows = [("2024-01-01 00:00:00", full(1)), ("2024-01-01 00:00:00", full(1)), ("2024-01-01 00:10:00", full(1))]
    rows += [(f"2024-01-01 01:{m:02d}:00", full(1)) for m in range(0, 60, 10)]
    out = {r.hour_of_day: r for r in hourly_datapoints(telemetry(spark, rows)).collect()}
    assert out[0].distinct_ts_count == 2 and out[0].missing_count == 4 and not out[0].is_complete
    assert out[1].distinct_ts_count == 6 and out[1].is_complete


def test_hourly_average_skips_missing_and_weights_duplicates(spark):
    rows = [
        ("2024-01-01 00:00:00", full(100)),
        ("2024-01-01 00:00:00", full(100)),  # duplicate weighs in
        ("2024-01-01 00:10:00", {ACTIVE_POWER: "400", WIND_SPEED: None}),  # null and missing keys
        ("2024-01-01 00:20:00", {ACTIVE_POWER: "oops", WIND_SPEED: "7"}),  # unparsable skipped
        ("2024-01-01 01:00:00", full(1000)),
    ]
    out = {r.hour_of_day: r for r in hourly_generation(telemetry(spark, rows)).collect()}
    assert out[0].avg_active_power == pytest.approx(200.0)
    assert out[0].avg_wind_speed == pytest.approx(69.0)
    assert out[0].avg_wind_direction == pytest.approx(100.0)
    assert out[0].generation_indicator == "Medium"
    assert out[1].generation_indicator == "Exceptional"


def test_long_has_four_rows_per_hour_with_nulls(spark):
    rows = [("2024-01-01 00:00:00", {ACTIVE_POWER: "1"}), ("2024-01-01 05:00:00", full(2))]
    hourly = hourly_generation(telemetry(spark, rows))
    long = to_long(hourly)
    assert long.count() == 4 * hourly.count()
    nulls = long.filter(F.col("value").isNull()).count()
    assert nulls == 3


def test_rename_duplicate_and_unmapped(spark):
    rows = [("2024-01-01 00:00:00", full(5))]
    long = to_long(hourly_generation(telemetry(spark, rows)))
    # the task's JSON repeats a key: no extra rows
    renamed = rename_signals(long, mapping_from_json(spark))
    assert renamed.count() == 4
    assert same_fields(renamed.schema, LONG_SCHEMA)
    # an unmapped signal keeps a null mapping
    partial = mapping_frame(spark, [(ACTIVE_POWER, "ap")])
    got = {r.sig_name: r.sig_mapping_name for r in rename_signals(long, partial).collect()}
    assert got[ACTIVE_POWER] == "ap" and got[WIND_DIRECTION] is None and len(got) == 4


def test_rename_large_dimension_takes_shuffle_join(spark):
    from sigflow.plans.inspect import uses_broadcast_join

    rows = [("2024-01-01 00:00:00", full(5))]
    long = to_long(hourly_generation(telemetry(spark, rows)))
    small = rename_signals(long, mapping_frame(spark))
    assert uses_broadcast_join(small)
    big = rename_signals(long, mapping_frame(spark), max_broadcast_bytes=2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not uses_broadcast_join(big)
        assert big.count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Golden hourly averages of the shipped 99-row sample (our own copy of the
# values, rounded to 4 places): hour -> (active power, wind speed,
# theoretical curve, wind direction, band).
GOLDEN = {
    0: (390.4804, 5.5069, 472.4022, 267.1186, "Medium"),
    1: (460.5371, 5.6442, 513.4184, 258.9455, "Medium"),
    2: (733.6554, 6.4520, 788.4013, 268.3975, "High"),
    3: (909.3621, 6.8115, 948.7933, 256.0148, "High"),
    4: (1393.5182, 7.7487, 1406.3918, 247.6525, "Exceptional"),
    5: (1149.5992, 7.2369, 1128.1944, 243.8463, "Exceptional"),
    6: (1100.0744, 7.1837, 1103.3728, 246.1174, "Exceptional"),
    7: (928.2428, 6.8047, 937.5711, 232.7554, "High"),
    8: (614.6531, 5.9850, 624.8216, 226.9672, "High"),
    9: (671.5084, 5.9850, 630.3573, 215.4005, "High"),
    10: (521.6255, 5.6614, 539.8362, 231.9428, "Medium"),
    11: (184.1824, 4.3000, 183.4078, 228.2274, "Low"),
    12: (127.3258, 3.8977, 119.1292, 230.3373, "Low"),
    13: (534.6638, 5.7685, 572.8157, 236.7904, "Medium"),
    14: (1329.2002, 7.8154, 1473.2329, 236.6030, "Exceptional"),
    15: (2157.7863, 9.3940, 2382.4660, 230.4043, "Exceptional"),
    16: (2580.6157, 10.1682, 2875.3419, 225.8246, "Exceptional"),
}


@pytest.mark.skipif(not SAMPLE_CSV or not os.path.exists(SAMPLE_CSV), reason="set SIGFLOW_SAMPLE_CSV")
def test_golden_sample(spark):
    raw = read_raw_csv(spark, SAMPLE_CSV, glob=None)
    assert raw.count() == 99
    tel = shape_telemetry(decode_messages(encode_messages(raw)))
    daily = daily_datapoints(tel).first()
    assert daily.distinct_ts_count == 99 and daily.missing_count == 45
    got = {r.hour_of_day: r for r in hourly_generation(tel).collect()}
    assert sorted(got) == list(range(17))
    for hour, (ap, ws, th, wd, label) in GOLDEN.items():
        r = got[hour]
        assert round(r.avg_active_power, 4) == pytest.approx(ap, abs=1e-9)
        assert round(r.avg_wind_speed, 4) == pytest.approx(ws, abs=1e-9)
        assert round(r.avg_theoretical_power_curve, 4) == pytest.approx(th, abs=1e-9)
        assert round(r.avg_wind_direction, 4) == pytest.approx(wd, abs=1e-9)
        assert r.generation_indicator == label
    assert to_long(hourly_generation(tel)).count() == 68
    per_hour = {r.hour_of_day: r.distinct_ts_count for r in hourly_datapoints(tel).collect()}
    assert all(per_hour[h] == 6 for h in range(16)) and per_hour[16] == 3
