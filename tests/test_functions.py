import math

import pytest
from pyspark.sql import functions as F

from sigflow.functions import band, parse_signal_ts, signal_value, signals_map
from sigflow.schemas import ACTIVE_POWER, SIGNAL_KEYS, WIND_SPEED


def test_band_edges(spark):
    values = [-1.0, 199.999, 200.0, 599.999, 600.0, 999.999, 1000.0, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.b for r in df.select("i", band(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == [
        "Low", "Low", "Medium", "Medium", "High", "High", "Exceptional", "Exceptional", "Exceptional",
    ]


def test_band_null_label(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 10.0)], "i int, v double")
    got = [r.b for r in df.select("i", band(F.col("v"), null_label=None).alias("b")).orderBy("i").collect()]
    assert got == [None, None, "Low"]


def test_band_custom_bounds(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double")
    got = sorted(r.b for r in df.select(band(F.col("v"), [1.0, 2.0], ["a", "b", "c"]).alias("b")).collect())
    assert got == ["a", "b", "c"]
    with pytest.raises(ValueError):
        band(F.col("v"), [2.0, 1.0], ["a", "b", "c"])
    with pytest.raises(ValueError):
        band(F.col("v"), [1.0], ["a"])


def test_signal_value_missing_and_bad_text(spark):
    df = spark.sql(
        "select map('LV ActivePower (kW)', '1.5', 'Wind Speed (m/s)', 'x') as signals"
    )
    row = df.select(
        signal_value(ACTIVE_POWER).alias("a"),
        signal_value(WIND_SPEED).alias("w"),
        signal_value("absent").alias("m"),
    ).first()
    assert row.a == 1.5 and row.w is None and row.m is None


def test_signals_map_keeps_nulls_and_rejects_duplicates(spark):
    df = spark.createDataFrame([(1.0, None, 3.0, 4.0)], "a double, b double, c double, d double")
    m = df.select(signals_map(SIGNAL_KEYS, [F.col(c) for c in "abcd"]).alias("m")).first().m
    assert sorted(m.keys()) == sorted(SIGNAL_KEYS)
    assert m[SIGNAL_KEYS[1]] is None and m[SIGNAL_KEYS[0]] == "1.0"
    with pytest.raises(ValueError):
        signals_map(["k", "k"], [F.lit(1), F.lit(2)])


def test_parse_ts_strict(spark):
    df = spark.createDataFrame(
        [("01 01 2018 00:10",), ("xx",), ("1 1 2018 3:50",), ("31 02 2018 00:00",)], "t string"
    )
    got = [r.ts for r in df.select(parse_signal_ts(F.col("t")).alias("ts")).collect()]
    assert got[0] is not None and got[0].minute == 10
    assert got[1:] == [None, None, None]
