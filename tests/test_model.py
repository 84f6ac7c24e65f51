import os

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_CSV, SF001
from sigflow.operators.ingest import decode_messages, encode_messages, shape_telemetry
from sigflow.operators.model import (
    LeastSquaresModel,
    assemble,
    evaluate_with_evaluator,
    fit_least_squares,
    hash_split,
    power_features,
    predict_day,
    regression_metrics,
    score,
    train_and_evaluate,
    train_power_model,
)
from sigflow.plans.inspect import partition_filters
from sigflow.plans.staging import load_telemetry
from sigflow.schemas import PREDICTION_SCHEMA
from sigflow.sources.csv import read_raw_csv


@pytest.mark.skipif(not SAMPLE_CSV or not os.path.exists(SAMPLE_CSV), reason="set SIGFLOW_SAMPLE_CSV")
def test_golden_regression_on_sample(spark):
    tel = shape_telemetry(decode_messages(encode_messages(read_raw_csv(spark, SAMPLE_CSV, glob=None))))
    data = assemble(power_features(tel))
    model = train_power_model(data)
    coef = list(model.coefficients.toArray())
    assert coef == pytest.approx([90.40881575, 0.69579270, -1.38475924], abs=1e-6)
    assert model.intercept == pytest.approx(-19.61170823, abs=1e-6)
    m = regression_metrics(score(model, data)).first()
    assert m.rmse == pytest.approx(48.68228776, abs=1e-6)
    assert m.r2 == pytest.approx(0.99358496, abs=1e-7)
    # the moments engine reaches the same solution
    ls = fit_least_squares(power_features(tel))
    assert list(ls.coefficients) == pytest.approx([90.40881575, 0.69579270, -1.38475924], abs=1e-6)
    assert ls.intercept == pytest.approx(-19.61170823, abs=1e-6)
    m2 = regression_metrics(score(ls, power_features(tel))).first()
    assert m2.rmse == pytest.approx(m.rmse, rel=1e-9)


def test_hash_split_disjoint_and_covering(spark):
    data = assemble(power_features(load_telemetry(spark, SF001)))
    train, test = hash_split(data, 0.8, split_hash="md5")
    n, a, b = data.count(), train.count(), test.count()
    assert a + b == n
    assert train.join(test, "signal_ts").count() == 0
    assert 0.7 < a / n < 0.9
    # layout independent: repartitioning gives the same rows
    train2, _ = hash_split(data.repartition(5), 0.8, split_hash="md5")
    assert train2.select("signal_ts").exceptAll(train.select("signal_ts")).count() == 0


def test_metrics_match_evaluator(spark):
    run = train_and_evaluate(load_telemetry(spark, SF001), persist=True, engine="ml")
    rmse, r2 = evaluate_with_evaluator(run.predictions)
    m = run.metrics().first()
    assert m.rmse == pytest.approx(rmse, rel=1e-9)
    assert m.r2 == pytest.approx(r2, rel=1e-6, abs=1e-9)
    run.features.unpersist()


def test_random_split_variant(spark):
    run = train_and_evaluate(load_telemetry(spark, SF001), split="random", persist=False)
    assert run.train.count() + run.test.count() == run.features.count()


def test_predict_day_prunes_partitions(spark):
    run = train_and_evaluate(load_telemetry(spark, SF001), persist=False)
    out = predict_day(run.model, power_features(load_telemetry(spark, SF001)), "2024-01-15")
    assert out.columns == [f.name for f in PREDICTION_SCHEMA.fields]
    assert any("signal_date" in f for f in partition_filters(out))
    assert out.filter(F.col("signal_date") != "2024-01-15").count() == 0
    assert out.count() > 0


def test_holdout_day_not_in_training(spark):
    run = train_and_evaluate(load_telemetry(spark, SF001), exclude_day="2024-01-15", persist=False)
    assert run.train.filter(F.col("signal_date") == "2024-01-15").count() == 0


def test_engines_agree(spark):
    tel = load_telemetry(spark, SF001)
    ml = train_and_evaluate(tel, engine="ml")
    mo = train_and_evaluate(tel, engine="moments")
    assert isinstance(mo.model, LeastSquaresModel)
    assert list(mo.model.coefficients) == pytest.approx(list(ml.model.coefficients.toArray()), rel=1e-9)
    assert mo.model.intercept == pytest.approx(ml.model.intercept, rel=1e-9)
    a, b = ml.metrics().first(), mo.metrics().first()
    assert a.n == b.n and a.rmse == pytest.approx(b.rmse, rel=1e-9)


def test_moments_scoring_has_no_udf(spark):
    from sigflow.plans.inspect import plan_text

    run = train_and_evaluate(load_telemetry(spark, SF001))
    text = plan_text(run.predictions, "simple")
    assert "UDF" not in text and "features" not in run.predictions.columns


def test_singular_system_falls_back(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, 2.0, float(i), 3.0 * i + 1.0) for i in range(20)],
        "wind_speed double, theoretical_curve double, wind_direction double, x double, active_power double",
    )
    m = fit_least_squares(df, feature_cols=("wind_speed", "x"))
    assert m.coefficients[1] == pytest.approx(3.0) and m.intercept == pytest.approx(1.0)


def test_keep_complete_equals_dropna(spark):
    from sigflow.operators.model import keep_complete

    nan = float("nan")
    rows = [(1, 1.0, 2.0), (2, None, 2.0), (3, nan, 1.0), (4, 3.0, None), (5, 4.0, 5.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    got = sorted(r.k for r in keep_complete(df, ["k"], ["a", "b"]).collect())
    want = sorted(r.k for r in df.dropna(subset=["a", "b"]).collect())
    assert got == want == [1, 5]
    assert keep_complete(df, ["k"], ["a", "b"]).columns == ["k", "a", "b"]


def test_xxhash_split_is_layout_independent(spark):
    feats = power_features(load_telemetry(spark, SF001))
    a, b = hash_split(feats, 0.8, split_hash="xxhash64")
    a2, _ = hash_split(feats.repartition(3), 0.8, split_hash="xxhash64")
    n = feats.count()
    assert a.count() + b.count() == n and 0.7 < a.count() / n < 0.9
    assert a.select("signal_ts").exceptAll(a2.select("signal_ts")).count() == 0
    run = train_and_evaluate(load_telemetry(spark, SF001), split_hash="xxhash64")
    assert run.metrics().first().n == b.count()


def test_evaluation_summary_matches_parts(spark):
    from sigflow.operators.model import chart_bounds, evaluation_summary

    run = train_and_evaluate(load_telemetry(spark, SF001))
    a = evaluation_summary(run.predictions).first()
    m, b = run.metrics().first(), chart_bounds(run.predictions).first()
    assert (a.n, a.rmse, a.r2, a.min_val, a.max_val) == (m.n, m.rmse, m.r2, b.min_val, b.max_val)


def test_rows_without_time_are_not_lost_by_the_split(spark):
    df = spark.createDataFrame(
        [(None, 1.0), ("2024-01-01 00:00:00", 2.0), ("2024-01-01 00:10:00", 3.0)], "t string, v double"
    ).select(F.to_timestamp("t").alias("signal_ts"), "v")
    for h in ("md5", "xxhash64"):
        a, b = hash_split(df, 0.5, split_hash=h)
        assert a.count() + b.count() == 3
        assert a.filter("signal_ts is null").count() == 1


def test_predict_day_prunes_partitions_with_ml_model(spark):
    run = train_and_evaluate(load_telemetry(spark, SF001), engine="ml")
    out = predict_day(run.model, power_features(load_telemetry(spark, SF001)), "2024-01-15")
    assert any("signal_date" in f for f in partition_filters(out))
    assert out.columns == [f.name for f in PREDICTION_SCHEMA.fields]
    moments = train_and_evaluate(load_telemetry(spark, SF001)).model
    other = predict_day(moments, power_features(load_telemetry(spark, SF001)), "2024-01-15")
    a = {r.signal_ts: r.prediction for r in out.collect()}
    b = {r.signal_ts: r.prediction for r in other.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 * max(1.0, abs(a[k])) for k in a)
