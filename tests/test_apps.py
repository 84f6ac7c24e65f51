"""The four stage applications, end to end on the file topic and Parquet."""

import os

from conftest import SF001
from sigflow import apps
from sigflow.sources.testdata import events_raw, read_events


def test_four_stages(spark, scratch):
    csv = os.path.join(scratch, "csv")
    events_raw(read_events(spark, SF001)).coalesce(2).write.option("header", True).csv(csv)
    topic = os.path.join(scratch, "topic")
    table = os.path.join(scratch, "table")
    out = os.path.join(scratch, "out")
    p = apps.parser()
    apps.run_produce(spark, p.parse_args(["produce", "--csv", csv, "--topic-path", topic,
                                          "--checkpoint", os.path.join(scratch, "ck1")]))
    apps.run_subscribe(spark, p.parse_args(["subscribe", "--topic-path", topic, "--table", table,
                                            "--checkpoint", os.path.join(scratch, "ck2")]))
    from sigflow.schemas import SIGNAL_MAPPING_JSON

    mapping_file = os.path.join(scratch, "mapping.json")
    with open(mapping_file, "w", encoding="utf-8") as fh:
        fh.write(SIGNAL_MAPPING_JSON)
    apps.run_analyze(spark, p.parse_args(["analyze", "--table", table, "--out", out, "--mapping-json", mapping_file]))
    apps.run_predict(spark, p.parse_args(["predict", "--table", table, "--out", out, "--day", "2024-01-15"]))
    hourly = spark.read.parquet(f"{out}/hourly")
    long = spark.read.parquet(f"{out}/hourly_long")
    assert long.count() == 4 * hourly.count()
    assert long.filter("sig_mapping_name is null").count() == 0
    assert spark.read.parquet(f"{out}/daily_datapoints").count() == 30
    assert spark.read.parquet(f"{out}/hourly_datapoints").count() == hourly.count()
    assert spark.read.parquet(f"{out}/predictions_2024-01-15").count() > 0
    assert spark.read.parquet(f"{out}/test_metrics").first().n > 0
    from sigflow.operators.model import LeastSquaresModel

    model = LeastSquaresModel.load(spark, f"{out}/model")
    assert model.feature_cols == ("wind_speed", "theoretical_curve", "wind_direction")
    apps.run_predict(spark, p.parse_args(["predict", "--table", table, "--out", out + "_ml", "--day", "2024-01-15",
                                          "--engine", "ml"]))
    ml = spark.read.parquet(f"{out}_ml/model_coefficients").first()
    assert abs(ml.intercept - model.intercept) < 1e-6 * abs(model.intercept)
    # The saved models predict the day again, without training.
    for kind in ("", "_ml"):
        apps.run_predict(spark, p.parse_args(["predict", "--table", table, "--out", f"{out}{kind}_again", "--day", "2024-01-15",
                                              "--model", f"{out}{kind}/model"]))
        names = [spark.read.parquet(f"{out}{kind}{x}/predictions_2024-01-15") for x in ("", "_again")]
        assert sorted(map(tuple, names[0].collect())) == sorted(map(tuple, names[1].collect()))
    assert not os.path.exists(f"{out}_again/model")


def test_subscribe_by_batches(spark, scratch):
    topic, table = os.path.join(scratch, "topic"), os.path.join(scratch, "table")
    os.makedirs(topic)
    with open(os.path.join(topic, "m.txt"), "w", encoding="utf-8") as fh:
        fh.write('{"Date/Time":"01 01 2024 00:10","Wind Speed (m/s)":2.5}\nnot json\n')
    p = apps.parser()
    apps.run_subscribe(spark, p.parse_args(["subscribe", "--topic-path", topic, "--table", table, "--checkpoint", os.path.join(scratch, "ck"),
                                            "--ledger", os.path.join(scratch, "ledger"), "--quarantine", os.path.join(scratch, "bad")]))
    rows = spark.read.parquet(table)
    assert rows.count() == 2 and rows.filter("readings.wind_speed = 2.5").count() == 1
    assert [r.malformed for r in spark.read.parquet(os.path.join(scratch, "bad")).collect()] == ["not json"]
