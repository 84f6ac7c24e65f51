"""The four stages as runnable applications (``python -m sigflow <stage>``).

    produce    CSV folder -> topic              (streaming)
    subscribe  topic -> telemetry table         (streaming)
    analyze    table -> daily and hourly counts, hourly averages with band, long table
    predict    table -> model, metrics, held-out series, one day's predictions

Results are written as tables under ``--out`` instead of printed; a preview
is printed only when ``--show`` is given. The session comes from
``spark-submit`` (master, resources, packages); Kafka and Delta are used when
chosen and their packages are on the class path.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from sigflow.operators.analysis import daily_from_hourly, hourly_datapoints, hourly_generation, rename_signals, to_long
from sigflow.operators.model import (
    actual_vs_predicted,
    as_pipeline,
    coefficients_frame,
    evaluation_summary,
    load_model,
    power_features,
    predict_day,
    save_model,
    train_and_evaluate,
)
from sigflow.operators.preview import preview
from sigflow.sources.mapping import mapping_frame, mapping_from_files
from sigflow.sources.table import TableConfig, read_table
from sigflow.sources.topic import TopicConfig
from sigflow.streaming import ingest_batches, ingest_topic, publish_csv


def _topic(args) -> TopicConfig:
    limit = getattr(args, "max_per_trigger", None)
    if args.kafka_servers:
        return TopicConfig(
            kind="kafka", bootstrap_servers=args.kafka_servers, topic=args.topic, max_offsets_per_trigger=limit
        )
    return TopicConfig(kind="files", path=args.topic_path, max_files_per_trigger=limit)


def _table(args) -> TableConfig:
    return TableConfig(path=args.table, format=args.table_format)


def _save(df: DataFrame, path: str, show: bool, order_by=None) -> None:
    df.write.mode("overwrite").parquet(path)
    if show:
        saved = df.sparkSession.read.parquet(path)
        preview(saved, order_by or df.columns[:2], 20).show(truncate=False)


def run_produce(spark: SparkSession, args) -> None:
    query = publish_csv(
        spark,
        args.csv,
        _topic(args),
        args.checkpoint,
        max_files_per_trigger=args.max_files_per_trigger,
        available_now=not args.continuous,
        processing_time=args.trigger if args.continuous else None,
    )
    if args.continuous:
        query.awaitTermination()


def run_subscribe(spark: SparkSession, args) -> None:
    if args.ledger:
        query = ingest_batches(
            spark,
            _topic(args),
            _table(args),
            args.ledger,
            args.checkpoint,
            quarantine=TableConfig(path=args.quarantine) if args.quarantine else None,
            dedupe_within=args.dedupe_within,
            typed=True,
            processing_time=args.trigger if args.continuous else None,
        )
        if args.continuous:
            query.awaitTermination()
        return
    query = ingest_topic(
        spark,
        _topic(args),
        _table(args),
        args.checkpoint,
        dedupe_within=args.dedupe_within,
        files_per_partition=args.files_per_date,
        available_now=not args.continuous,
        processing_time=args.trigger if args.continuous else None,
    )
    if args.continuous:
        query.awaitTermination()


def run_analyze(spark: SparkSession, args) -> None:
    telemetry = read_table(spark, _table(args))
    # One distinct pass: the daily counts are summed from the written hourly ones.
    _save(hourly_datapoints(telemetry), f"{args.out}/hourly_datapoints", args.show)
    hourly_counts = spark.read.parquet(f"{args.out}/hourly_datapoints")
    _save(daily_from_hourly(hourly_counts), f"{args.out}/daily_datapoints", args.show)
    hourly = hourly_generation(telemetry)
    _save(hourly, f"{args.out}/hourly", args.show)
    # Read the hourly table back: the long form reuses it instead of
    # re-aggregating the whole telemetry table.
    hourly = spark.read.parquet(f"{args.out}/hourly")
    if args.mapping_json:
        mapping = mapping_from_files(spark, args.mapping_json)
    else:
        mapping = mapping_frame(spark)
    _save(rename_signals(to_long(hourly), mapping), f"{args.out}/hourly_long", args.show)


def run_predict(spark: SparkSession, args) -> None:
    telemetry = read_table(spark, _table(args))
    if args.model:
        # A saved model: no training, only the day is read.
        day = predict_day(load_model(spark, args.model), power_features(telemetry), args.day)
        _save(day, f"{args.out}/predictions_{args.day}", args.show, ["signal_ts"])
        return
    # The map is decoded once; the passes below read typed columns.
    typed = power_features(telemetry)
    typed.write.mode("overwrite").partitionBy("signal_date").parquet(f"{args.out}/features")
    features = spark.read.schema(typed.schema).parquet(f"{args.out}/features").select(*typed.columns)
    run = train_and_evaluate(
        telemetry,
        features=features,
        split=args.split,
        exclude_day=args.day if args.holdout_day else None,
        persist=args.persist,
        engine=args.engine,
        split_hash=args.split_hash,
    )
    coefficients_frame(run.model, spark).write.mode("overwrite").parquet(f"{args.out}/model_coefficients")
    # Metrics and chart bounds in one pass over the held-out rows.
    evaluation_summary(run.predictions).write.mode("overwrite").parquet(f"{args.out}/test_metrics")
    actual_vs_predicted(run.predictions).write.mode("overwrite").parquet(f"{args.out}/test_series")
    if args.engine == "ml":
        save_model(as_pipeline(run.model), spark, f"{args.out}/model")
    else:
        save_model(run.model, spark, f"{args.out}/model")
    day = predict_day(run.model, features, args.day)
    _save(day, f"{args.out}/predictions_{args.day}", args.show, ["signal_ts"])
    if args.show:
        print(json.dumps(spark.read.parquet(f"{args.out}/test_metrics").first().asDict()))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sigflow")
    sub = p.add_subparsers(dest="stage", required=True)

    def topic_args(sp):
        sp.add_argument("--topic-path", help="folder of the file topic")
        sp.add_argument("--kafka-servers", help="Kafka bootstrap servers (uses Kafka)")
        sp.add_argument("--topic", help="Kafka topic name")

    def table_args(sp):
        sp.add_argument("--table", required=True)
        sp.add_argument("--table-format", default="parquet", choices=["parquet", "delta"])

    def stream_args(sp):
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--continuous", action="store_true", help="keep running")
        sp.add_argument("--trigger", default="1 minute", help="processing-time trigger when continuous")

    sp = sub.add_parser("produce")
    sp.add_argument("--csv", required=True)
    sp.add_argument("--max-files-per-trigger", type=int)
    topic_args(sp)
    stream_args(sp)

    sp = sub.add_parser("subscribe")
    sp.add_argument("--dedupe-within", help="drop repeated readings within this delay")
    sp.add_argument("--ledger", help="write idempotent batches with typed readings and record them in this folder")
    sp.add_argument("--quarantine", help="table for the texts of messages that can't be read in full (with --ledger)")
    sp.add_argument("--files-per-date", type=int, help="at most this many files per date per batch (one shuffle)")
    sp.add_argument("--max-per-trigger", type=int,
                    help="bound each batch: topic files (file topic) or offsets (Kafka)")
    topic_args(sp)
    table_args(sp)
    stream_args(sp)

    sp = sub.add_parser("analyze")
    table_args(sp)
    sp.add_argument("--out", required=True)
    sp.add_argument("--mapping-json", help="file with the JSON array of signal names")
    sp.add_argument("--show", action="store_true")

    sp = sub.add_parser("predict")
    table_args(sp)
    sp.add_argument("--out", required=True)
    sp.add_argument("--day", required=True)
    sp.add_argument("--model", help="a model that an earlier run saved: predict only")
    sp.add_argument("--split", default="hash", choices=["hash", "random"])
    sp.add_argument("--engine", default="moments", choices=["moments", "ml"],
                    help="moments: one aggregate pass; ml: pyspark.ml LinearRegression")
    sp.add_argument("--split-hash", default="xxhash64", choices=["xxhash64", "md5"])
    sp.add_argument("--holdout-day", action="store_true", help="keep the day out of training")
    sp.add_argument("--persist", action="store_true", help="keep feature rows cached across passes")
    sp.add_argument("--show", action="store_true")
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"sigflow-{args.stage}").getOrCreate()
    {"produce": run_produce, "subscribe": run_subscribe, "analyze": run_analyze, "predict": run_predict}[
        args.stage
    ](spark, args)
