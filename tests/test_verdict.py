"""Input that must not get lost, results that must follow the data."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from sigflow.operators.ingest import shape_telemetry
from sigflow.operators.model import evaluate_with_evaluator, evaluation_summary, fit_least_squares, is_train, regression_metrics
from sigflow.schemas import LABEL_COLUMN, RAW_SCHEMA, TELEMETRY_SCHEMA, same_fields
from sigflow.session import file_signature
from sigflow.sources.csv import read_raw_csv
from sigflow.sources.mapping import mapping_from_files, unique_mapping
from sigflow.sources.table import TableConfig, read_table, spread_by_partition, write_table
from sigflow.sources.topic import TopicConfig, read_topic
from sigflow.streaming import publish_csv

HEADER = ",".join(f.name for f in RAW_SCHEMA.fields)
LINE = "01 01 2018 00:00,1.0,2.0,3.0,4.0"


def put(path, age_days=0, opener=open):
    with opener(path, "wt") as f:
        f.write(f"{HEADER}\n{LINE}\n")
    if age_days:
        t = os.path.getmtime(path) - 86400 * age_days
        os.utime(path, (t, t))


def test_back_dated_delivery_arrives_after_a_restart(spark, scratch):
    os.makedirs(f"{scratch}/in")
    topic = TopicConfig(path=f"{scratch}/topic")
    for k, age in enumerate((0, 30, 0)):
        put(f"{scratch}/in/{k}.csv", age)
        publish_csv(spark, f"{scratch}/in", topic, f"{scratch}/check")
        assert read_topic(spark, topic, streaming=False).count() == k + 1


def test_csv_names(spark, scratch):
    for name, opener in (("a.csv", open), ("b.CSV", open), ("c.csv.gz", gzip.open), ("d.csv.old", open), ("e.txt", open)):
        put(f"{scratch}/{name}", opener=opener)
    assert read_raw_csv(spark, scratch).count() == 3


def test_mapping_files_and_conflicts(spark, scratch):
    for name, mapped in (("a", "x"), ("b", "y")):
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(f'[{{"sig_name": "{name}", "sig_mapping_name": "{mapped}"}}]')
    assert {tuple(r) for r in mapping_from_files(spark, scratch).collect()} == {("a", "x"), ("b", "y")}
    two = spark.createDataFrame([("k", "z"), ("k", "a")], "sig_name string, sig_mapping_name string")
    with pytest.raises(Exception, match="mapped two ways"):
        unique_mapping(two).collect()


@pytest.mark.parametrize("rows", [[(1.0, 1.5), (1.0, 0.5)], [(2.0, 1.0)], [(1.0, 2.0), (3.0, 3.5)]])
def test_metrics_equal_the_evaluator(spark, rows):
    frame = spark.createDataFrame(rows, f"{LABEL_COLUMN} double, prediction double")
    rmse, r2 = evaluate_with_evaluator(frame)
    for got in (regression_metrics(frame).first(), evaluation_summary(frame).first()):
        assert got.rmse == pytest.approx(rmse) and got.r2 == pytest.approx(r2)


def test_metrics_of_an_empty_set(spark):
    got = regression_metrics(spark.createDataFrame([], f"{LABEL_COLUMN} double, prediction double")).first()
    assert (got.n, got.rmse, got.r2) == (0, None, None)


def test_batch_write_into_a_streamed_table_is_refused(spark, scratch):
    os.makedirs(f"{scratch}/t/_spark_metadata")
    with pytest.raises(ValueError, match="stream"):
        write_table(spark.range(1).withColumn("signal_date", F.current_date()), TableConfig(f"{scratch}/t"))


def test_alike_rows_spread_over_tasks(spark):
    rows = spark.range(10_000, numPartitions=2).select(F.lit(None).cast("date").alias("signal_date"), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join small partitions again
    try:
        parts = spread_by_partition(rows, ["signal_date"], 8).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) > 2 and max(r["count"] for r in parts) < 8_000


def test_split_of_instants_is_the_same_in_two_time_zones(spark):
    rows = spark.range(200).select("id", (F.timestamp_seconds(F.col("id") * 600)).alias("signal_ts"))
    zone, sides = spark.conf.get("spark.sql.session.timeZone"), []
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            sides.append({r.id for r in rows.filter(is_train(0.8, split_hash="md5")).collect()})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sides[0] == sides[1] and 120 < len(sides[0]) < 190


def test_collinear_features_share_the_weight(spark):
    rows = spark.range(400).select((F.col("id") % 20 / 2.0).alias("wind_speed"), (F.col("id") * 7 % 90).cast("double").alias("wind_direction"))
    rows = rows.withColumn("theoretical_curve", 0.1 * F.col("wind_speed") + 0.3)
    rows = rows.withColumn(LABEL_COLUMN, 90.0 * F.col("wind_speed") - F.col("wind_direction") + 5)
    model = fit_least_squares(rows)
    assert model.coefficients == pytest.approx((45.0, 450.0, -1.0), rel=1e-6)
    got = regression_metrics(model.transform(rows)).first()
    assert got.rmse == pytest.approx(0, abs=1e-6)


def test_table_of_malformed_messages_has_the_telemetry_schema(spark, scratch):
    rows = spark.createDataFrame([(None,) * len(RAW_SCHEMA)], RAW_SCHEMA)
    cfg = TableConfig(f"{scratch}/malformed")
    write_table(shape_telemetry(rows), cfg)
    got = read_table(spark, cfg)
    assert same_fields(got.schema, TELEMETRY_SCHEMA) and got.count() == 1


def test_signature_sees_files_inside_a_folder(spark, scratch):
    os.makedirs(f"{scratch}/d/p=1")
    put(f"{scratch}/d/p=1/a.csv")
    before = file_signature(spark, f"{scratch}/d")
    put(f"{scratch}/d/p=1/b.csv")
    assert file_signature(spark, f"{scratch}/d") != before and file_signature(spark, f"{scratch}/none") is None
