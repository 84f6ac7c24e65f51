"""Typed readings, bitmaps, buckets, saved models, file names, size checks."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sigflow.operators.analysis import daily_datapoints, daily_from_bitmaps, hourly_averages, hourly_datapoints, hourly_from_bitmaps, minute_bitmaps, slots_seen
from sigflow.operators.joins import dimension_bytes, join_dimension
from sigflow.operators.model import LeastSquaresModel, assemble, load_model, power_features, predict_day, save_model, train_and_evaluate, train_pipeline, train_power_model
from sigflow.plans.inspect import plan_text, read_schemas, uses_broadcast_join
from sigflow.plans.staging import load_telemetry, load_typed_telemetry
from sigflow.schemas import RAW_SCHEMA, SIGNAL_KEYS
from sigflow.sources.csv import check_deliveries, read_raw_csv
from sigflow.sources.table import open_bucketed, write_bucketed


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------- typed
def test_typed_table_is_read_without_the_map(spark):
    typed, plain = load_typed_telemetry(spark, SF001), load_telemetry(spark, SF001)
    assert all("signals" not in s for s in read_schemas(hourly_averages(typed)))
    assert any("signals" in s for s in read_schemas(hourly_averages(plain)))
    rounded = [c for c in hourly_averages(plain).columns if c.startswith("avg_")]
    both = [hourly_averages(t).withColumns({c: F.round(c, 6) for c in rounded}) for t in (typed, plain)]
    assert rows_of(both[0]) == rows_of(both[1])
    assert all("signals" not in s for s in read_schemas(power_features(typed)))
    assert rows_of(power_features(typed)) == rows_of(power_features(plain))


# ----------------------------------------------------------------- bitmaps
def timed(spark, texts):
    rows = [(datetime.date.fromisoformat(t[:10]) if t else None, t) for t in texts]
    return spark.createDataFrame(rows, "signal_date date, t string").select("signal_date", F.col("t").cast("timestamp").alias("signal_ts"))


def test_bitmaps_count_like_distinct(spark):
    texts = [f"2024-01-0{d} {h:02d}:{m:02d}:00" for d in (1, 2) for h in range(0, 24, 3) for m in range(0, 60, 7 * d)] * 2 + [None, None]
    rows = timed(spark, texts).repartition(5)
    bitmaps = minute_bitmaps(rows)
    assert rows_of(hourly_from_bitmaps(bitmaps)) == rows_of(hourly_datapoints(rows))
    assert rows_of(daily_from_bitmaps(bitmaps)) == rows_of(daily_datapoints(rows))
    want = rows.filter("signal_ts IS NOT NULL").groupBy(F.hour("signal_ts").alias("h")).agg(F.count_distinct(F.minute("signal_ts")))
    assert rows_of(slots_seen(bitmaps).filter("hour_of_day IS NOT NULL")) == rows_of(want)
    # One shuffle of a bitmap per task, date and hour; the times stay.
    plan = plan_text(hourly_from_bitmaps(bitmaps), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(signal_date" in plan and "signal_ts" not in plan.split("Exchange hashpartitioning")[1].split("\n")[0]


@pytest.mark.parametrize("text", ["2024-01-01 00:00:01", "2024-01-01 00:00:00.5"])
def test_finer_times_fail_instead_of_miscounting(spark, text):
    with pytest.raises(Exception, match="whole minute"):
        daily_from_bitmaps(minute_bitmaps(timed(spark, ["2024-01-01 00:00:00", text]))).collect()


# ----------------------------------------------------------------- buckets
def test_bucketed_table_needs_no_shuffle(spark, scratch):
    path = os.path.join(scratch, "bucketed")
    table = write_bucketed(load_typed_telemetry(spark, SF001), "telemetry_bucketed_test", path, 4)
    by_hour = hourly_averages(table)
    assert "Exchange" not in plan_text(by_hour, "simple")
    assert "Exchange" in plan_text(hourly_averages(load_typed_telemetry(spark, SF001)), "simple")
    rounded = {c: F.round(c, 6) for c in by_hour.columns if c.startswith("avg_")}
    want = rows_of(hourly_averages(load_typed_telemetry(spark, SF001)).withColumns(rounded))
    assert rows_of(by_hour.withColumns(rounded)) == want
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    again = hourly_averages(open_bucketed(spark, "telemetry_bucketed_again", path, ddl, 4))
    assert "Exchange" not in plan_text(again, "simple")
    assert rows_of(again.withColumns(rounded)) == want


# ------------------------------------------------------------------ models
def test_saved_models_predict_alike(spark, scratch):
    features = power_features(load_typed_telemetry(spark, SF001))
    run = train_and_evaluate(None, features=features)
    models = {"pipeline": train_pipeline(features), "regression": train_power_model(assemble(features)), "moments": run.model}
    day = "2024-01-15"
    for name, model in models.items():
        path = os.path.join(scratch, name)
        save_model(model, spark, path)
        loaded = load_model(spark, path)
        assert type(loaded) is type(model)
        assert rows_of(predict_day(loaded, features, day)) == rows_of(predict_day(model, features, day))
    assert isinstance(load_model(spark, os.path.join(scratch, "moments")), LeastSquaresModel)


def test_excluded_day_keeps_rows_without_a_date(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(d, None, float(i), float(i * i), float(i % 3), 2.0 * i) for i, d in enumerate([day, None, datetime.date(2024, 1, 2), None])]
    features = spark.createDataFrame(rows, "signal_date date, signal_ts timestamp, wind_speed double, theoretical_curve double, wind_direction double, active_power double")
    run = train_and_evaluate(None, features=features, exclude_day=day)
    assert run.train.count() == 3


# --------------------------------------------------------------- csv names
HEADER = ",".join(f.name for f in RAW_SCHEMA)
LINE = "01 01 2018 00:00,1,2,3,4"


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join((HEADER, *lines)) + "\n")


def test_part_files_without_extension_are_read(spark, scratch):
    put(scratch, "part-00000", LINE)
    put(scratch, "part-m-00001", LINE)
    put(scratch, "a.CSV", LINE)
    put(scratch, "_SUCCESS")
    put(scratch, "b.csv.old", LINE)
    assert read_raw_csv(spark, scratch).count() == 3


@pytest.mark.parametrize("name", ["a.csv.BZ2", "delivery", "a.csv.zip", "part-x"])
def test_other_names_are_errors(spark, scratch, name):
    put(scratch, "a.csv", LINE)
    put(os.path.join(scratch, "more"), name, LINE)
    with pytest.raises(ValueError, match=name):
        check_deliveries(spark, scratch)
    with pytest.raises(ValueError, match=name):
        read_raw_csv(spark, scratch)


def test_malformed_csv_lines_are_kept(spark, scratch):
    put(scratch, "a.csv", LINE, "01 01 2018 00:10,x,2,3,4", "01 01 2018 00:20,1")
    got = {r.malformed for r in read_raw_csv(spark, scratch, malformed="malformed").collect()}
    assert got == {None, "01 01 2018 00:10,x,2,3,4", "01 01 2018 00:20,1"}
    assert read_raw_csv(spark, scratch).schema == RAW_SCHEMA


# ------------------------------------------------------------- broadcasting
def test_broadcast_goes_by_bytes(spark):
    fact = spark.createDataFrame([("a", 1)], "k string, v int")
    wide = spark.createDataFrame([("a", "x" * 5000)], "k string, w string")
    assert dimension_bytes(wide) > 5000
    assert uses_broadcast_join(join_dimension(fact, wide, "k"))
    large = join_dimension(fact, wide, "k", max_broadcast_bytes=1000)
    assert not uses_broadcast_join(large) and large.count() == 1
    assert dimension_bytes(wide.limit(0)) == 0


def test_signal_keys_are_the_typed_columns(spark):
    row = load_typed_telemetry(spark, SF001).select("readings.*", "signals").first()
    assert [None if row.signals[k] is None else float(row.signals[k]) for k in SIGNAL_KEYS] == list(row)[:4]
