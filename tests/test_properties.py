"""Property tests (hypothesis) on the pure column expressions."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigflow.functions import band, signal_value, signals_map
from sigflow.operators.analysis import hourly_generation, to_long
from sigflow.schemas import BAND_LABELS, SIGNAL_KEYS

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
doubles = st.floats(allow_nan=False, allow_infinity=False, width=64)


@SETTINGS
@given(st.lists(doubles, min_size=1, max_size=20))
def test_double_text_double_is_identity(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    m = df.select("v", signals_map([SIGNAL_KEYS[0]], [F.col("v")]).alias("signals"))
    back = m.select("v", signal_value(SIGNAL_KEYS[0]).alias("w")).collect()
    assert all(r.v == r.w for r in back)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(width=64)), min_size=1, max_size=20))
def test_band_is_total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    labels = [r.b for r in df.select(band(F.col("v")).alias("b")).collect()]
    assert all(label in BAND_LABELS for label in labels)
    for v, label in zip(values, labels):
        if v is not None and not math.isnan(v) and v < 200:
            assert label == "Low"


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 47), st.one_of(st.none(), doubles.filter(lambda x: abs(x) < 1e9))),
                min_size=1, max_size=30))
def test_long_is_four_times_wide(spark, rows):
    data = [(f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00", {k: (None if v is None else str(v)) for k in SIGNAL_KEYS})
            for h, v in rows]
    df = spark.createDataFrame(data, "t string, signals map<string,string>").select(
        F.to_date(F.to_timestamp("t")).alias("signal_date"), F.to_timestamp("t").alias("signal_ts"), "signals")
    hourly = hourly_generation(df)
    assert to_long(hourly).count() == 4 * hourly.count()


def _band_rule(v):
    """The task's rule in plain Python (NaN and null fall through)."""
    if v is None or math.isnan(v):
        return "Exceptional"
    if v < 200:
        return "Low"
    if v < 600:
        return "Medium"
    if v < 1000:
        return "High"
    return "Exceptional"


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(width=64), st.sampled_from([199.999, 200.0, 600.0, 1000.0])),
                min_size=1, max_size=25))
def test_band_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.b for r in df.select("i", band(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == [_band_rule(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(width=64)), st.one_of(st.none(), st.floats(width=64))),
                min_size=1, max_size=25))
def test_keep_complete_equals_dropna(spark, rows):
    from sigflow.operators.model import keep_complete

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "k int, a double, b double")
    got = sorted(r.k for r in keep_complete(df, ["k"], ["a", "b"]).collect())
    want = sorted(r.k for r in df.dropna(subset=["a", "b"]).collect())
    assert got == want


@SETTINGS
@given(st.floats(0.05, 0.95), st.sampled_from(["md5", "xxhash64"]))
def test_hash_split_partitions_rows(spark, fraction, split_hash):
    from sigflow.operators.model import hash_split

    df = spark.range(300).select(F.timestamp_seconds(F.col("id") * 7919).alias("signal_ts"))
    a, b = hash_split(df, fraction, split_hash=split_hash)
    assert a.count() + b.count() == 300
    assert a.join(b, "signal_ts").count() == 0
