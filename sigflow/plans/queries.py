"""The registered queries: one ``(spark, sf_dir) -> DataFrame`` per operator
derives from them) in full. The fixed parameters below are shared with the
oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sigflow.functions.signals import reading, signal_value
from sigflow.operators.analysis import (
    daily_datapoints,
    daily_from_bitmaps,
    daily_from_hourly,
    hourly_averages,
    hourly_datapoints,
    hourly_from_bitmaps,
    hourly_generation,
    minute_bitmaps,
    rename_signals,
    slots_seen,
    to_long,
)
from sigflow.operators.ingest import decode_messages, encode_messages, shape_telemetry
from sigflow.operators.model import (
    PowerModelRun,
    actual_vs_predicted,
    assemble,
    chart_bounds,
    coefficients_frame,
    evaluate_with_evaluator,
    features_as_array,
    is_train,
    load_model,
    power_features,
    predict_day,
    random_split,
    regression_metrics,
    save_model,
    train_and_evaluate,
    train_pipeline,
    typed_signals,
)
from sigflow.operators.preview import preview
from sigflow.plans.staging import FILES_PER_BATCH, load_telemetry, load_typed_telemetry, message_folder, raw_csv_folder, second_delivery
from sigflow.schemas import AVG_COLUMNS, FEATURE_COLUMNS, RAW_SCHEMA, SIGNAL_KEYS, TYPED_COLUMNS
from sigflow.session import new_scratch_dir
from sigflow.sources.csv import read_raw_csv
from sigflow.sources.mapping import mapping_frame, mapping_from_json
from sigflow.sources.table import TableConfig, read_table, write_bucketed
from sigflow.sources.testdata import events_raw, read_events
from sigflow.sources.topic import TopicConfig, read_topic
from sigflow.streaming import ingest_batches, ingest_drifting_csv, ingest_topic, publish_csv, read_batches, read_drift_table, read_ledger, read_quarantine

# Fixed query parameters. The split hashes with md5 so that the SQL oracle
# can reproduce which rows train.
SPLIT_HASH = "md5"
PREDICT_DAY = "2024-01-15"
PREVIEW_ROWS = 5
BUCKETS = 8
REPEATS_WITHIN = "1 hour"
TRAIN_FRACTION = 0.8
# Model outputs are rounded: Spark and the SQL closed form agree to about
# 1e-12 relative, not bit for bit.
COEF_DECIMALS = 6
VALUE_DECIMALS = 2
METRIC_DECIMALS = 6

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- analysis
def hourly_generation_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 + C5: hourly averages of every signal with the generation band."""
    return _round_averages(hourly_generation(load_telemetry(spark, sf_dir)))


def _round_averages(hourly: DataFrame) -> DataFrame:
    """Averages rounded: the order of a double sum is not fixed."""
    return hourly.withColumns({c: F.round(c, METRIC_DECIMALS) for c in AVG_COLUMNS})


def hourly_generation_typed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 + C5 from the typed readings beside the map (F12, M1): the scan
    reads four doubles and not the map."""
    return _round_averages(hourly_generation(load_typed_telemetry(spark, sf_dir)))


def hourly_generation_bucketed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 + C5 over a table bucketed by date and hour (S5, A3): the hourly
    aggregate needs no shuffle."""
    path = new_scratch_dir(spark, "bucketed")
    table = write_bucketed(load_typed_telemetry(spark, sf_dir), "telemetry_" + path.rsplit("-", 1)[-1], path, BUCKETS)
    return _round_averages(hourly_generation(table))


def hourly_averages_avg_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 + A2: hourly averages with ``avg`` itself, NaN readings included;
    rounded, as the order of a double sum is not fixed."""
    return _round_averages(hourly_averages(load_telemetry(spark, sf_dir)))


def daily_datapoints_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 + A5: distinct timestamps per day and completeness."""
    return daily_datapoints(load_telemetry(spark, sf_dir))


def hourly_datapoints_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 per hour: distinct timestamps per (date, hour) against 6."""
    return hourly_datapoints(load_telemetry(spark, sf_dir))


def daily_from_hourly_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 derived from the hourly counts (one distinct shuffle for both)."""
    return daily_from_hourly(hourly_datapoints(load_telemetry(spark, sf_dir)))


def _minute_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry as ingest shapes it: times in whole minutes."""
    return shape_telemetry(decode_messages(encode_messages(events_raw(read_events(spark, sf_dir)))))


def daily_datapoints_bitmap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 + A1 by bitmaps of the minutes in place of distinct times."""
    return daily_from_bitmaps(minute_bitmaps(_minute_telemetry(spark, sf_dir)))


def hourly_datapoints_bitmap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 per hour by bitmaps of the minutes."""
    return hourly_from_bitmaps(minute_bitmaps(_minute_telemetry(spark, sf_dir)))


def minutes_seen_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 by merged bitmaps: minutes of each hour seen on any date."""
    return slots_seen(minute_bitmaps(_minute_telemetry(spark, sf_dir)))


def hourly_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (date, hour, signal)."""
    return to_long(hourly_generation_q(spark, sf_dir))


def hourly_long_unpivot_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 through ``DataFrame.unpivot`` (cross-check of the explode form)."""
    return to_long(hourly_generation_q(spark, sf_dir), method="unpivot")


def hourly_long_renamed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 with the inline mapping (S6) and the broadcast left join."""
    return rename_signals(
        hourly_long_q(spark, sf_dir), mapping_frame(spark), assume_unique=True
    )


def hourly_long_renamed_json_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 with the mapping parsed from the task's JSON array."""
    return rename_signals(
        hourly_long_q(spark, sf_dir),
        mapping_from_json(spark),
        assume_unique=True,
    )


def hourly_preview_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 / O2: the first rows of the hourly table in key order."""
    return preview(hourly_generation_q(spark, sf_dir), ["signal_date", "hour_of_day"], PREVIEW_ROWS)


# ------------------------------------------------------- sources and ingest
def _checked_telemetry(telemetry: DataFrame, *more: str) -> DataFrame:
    """Telemetry rows in comparable form: time-zone-free time, ingest columns
    reduced to presence, signal values looked up as doubles."""
    return telemetry.select(
        "signal_date",
        F.col("signal_ts").cast("timestamp_ntz").alias("signal_ts"),
        F.col("create_date").isNotNull().alias("has_create_date"),
        F.col("create_ts").isNotNull().alias("has_create_ts"),
        *[signal_value(k).alias(n) for n, k in zip(TYPED_COLUMNS, SIGNAL_KEYS)],
        *more,
    )


def raw_csv_scan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch CSV scan with header and fixed schema."""
    return read_raw_csv(spark, raw_csv_folder(spark, sf_dir))


def raw_csv_scan_inferred_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 as the reference writes it: header and schema inference (one more
    pass over the files); the inferred schema is what S2 hands to a stream."""
    return read_raw_csv(spark, raw_csv_folder(spark, sf_dir), infer_schema=True)


def csv_inferred_to_topic_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + C1: a batch scan infers the schema, the stream reuses it."""
    source = raw_csv_folder(spark, sf_dir)
    schema = read_raw_csv(spark, source, infer_schema=True).schema
    run = new_scratch_dir(spark, "csv-inferred-to-topic")
    topic = TopicConfig(path=f"{run}/topic")
    publish_csv(spark, source, topic, f"{run}/checkpoint-producer", schema=schema, max_files_per_trigger=FILES_PER_BATCH)
    return decode_messages(read_topic(spark, topic, streaming=False))


def csv_drift_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over files whose headers differ. Half of the rows are
    delivered as they are, the others with their columns in another order and
    a further one; a delivery of all rows without one column is quarantined,
    so each row is in the table once."""
    run = new_scratch_dir(spark, "drift")
    events = read_events(spark, sf_dir)
    early = F.col("ts") < F.lit(PREDICT_DAY)
    late = events_raw(events.filter(~early | early.isNull()))
    deliveries = (
        events_raw(events.filter(early)),
        late.select(*reversed(late.columns), F.lit("x, y").alias("Note")),
        events_raw(events).drop(SIGNAL_KEYS[-1]),
    )
    for rows in deliveries:
        rows.write.mode("append").option("header", True).csv(f"{run}/inbox")
    table, report = TableConfig(path=f"{run}/raw"), TableConfig(path=f"{run}/report")
    ingest_drifting_csv(spark, f"{run}/inbox", table, report, f"{run}/checkpoint", max_files_per_trigger=FILES_PER_BATCH)
    return read_drift_table(spark, table).select(*RAW_SCHEMA.names)


def message_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 / F3 / P2 then F2 / P5: rows -> JSON messages -> rows (batch)."""
    return decode_messages(encode_messages(events_raw(read_events(spark, sf_dir))))


def ingest_batch_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2's transformation as a batch: messages -> telemetry rows."""
    messages = encode_messages(events_raw(read_events(spark, sf_dir)))
    return _checked_telemetry(shape_telemetry(decode_messages(messages)))


def csv_to_topic_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the CSV folder into a new topic, read the topic back."""
    run = new_scratch_dir(spark, "csv-to-topic")
    topic = TopicConfig(path=f"{run}/topic")
    publish_csv(spark, raw_csv_folder(spark, sf_dir), topic, f"{run}/checkpoint-producer", max_files_per_trigger=FILES_PER_BATCH)
    return decode_messages(read_topic(spark, topic, streaming=False))


def _ingested_table(spark: SparkSession, sf_dir: str, name: str) -> TableConfig:
    """Run the producer and subscriber streams into a new table, in several
    micro-batches each."""
    run = new_scratch_dir(spark, name)
    topic = TopicConfig(path=f"{run}/topic", max_files_per_trigger=FILES_PER_BATCH)
    table = TableConfig(path=f"{run}/telemetry")
    publish_csv(spark, raw_csv_folder(spark, sf_dir), topic, f"{run}/checkpoint-producer", max_files_per_trigger=FILES_PER_BATCH)
    ingest_topic(spark, topic, table, f"{run}/checkpoint-subscriber")
    return table


def topic_to_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 / T2, T4, T5: CSV -> topic -> telemetry table, read back."""
    return _checked_telemetry(read_table(spark, _ingested_table(spark, sf_dir, "topic-to-table")))


def ingested_hourly_generation_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages before the model: CSV -> topic -> table -> hourly averages
    with band, over the time the ingest parsed (minute resolution)."""
    telemetry = read_table(spark, _ingested_table(spark, sf_dir, "ingested-hourly"))
    return _round_averages(hourly_generation(telemetry))


def _ingested_batches(spark: SparkSession, sf_dir: str, name: str, typed: bool = False, stop_after: int | None = None, repeat: bool = False) -> tuple[TableConfig, str, TableConfig]:
    """Run the subscriber by idempotent batches over the messages, into a new
    table, ledger and quarantine. ``stop_after``: the query ends between that
    batch's write and its record, and is started again. ``repeat``: every
    message comes twice, the second time in later batches."""
    run = new_scratch_dir(spark, name)
    inbox = message_folder(spark, sf_dir)
    if repeat:
        messages = spark.read.text(inbox)
        for _ in range(2):
            messages.write.mode("append").text(f"{run}/inbox")
        inbox = f"{run}/inbox"
    topic = TopicConfig(path=inbox, max_files_per_trigger=FILES_PER_BATCH)
    table, quarantine, ledger = TableConfig(path=f"{run}/telemetry"), TableConfig(path=f"{run}/quarantine"), f"{run}/ledger"

    def stop(batch_id: int) -> None:
        if batch_id == stop_after:
            raise RuntimeError("stopped between write and record")

    def ingest(hook) -> None:
        ingest_batches(spark, topic, table, ledger, f"{run}/checkpoint", quarantine, typed=typed, dedupe_within=REPEATS_WITHIN if repeat else None, after_write=hook)

    if stop_after is not None:
        try:
            ingest(stop)
        except StreamingQueryException:
            pass
    ingest(None)
    return table, ledger, quarantine


def batch_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 / T2, K2 by idempotent batches, with the text of bad messages."""
    table, _, _ = _ingested_batches(spark, sf_dir, "batch-ingest")
    return _checked_telemetry(read_batches(spark, table), "malformed")


def batch_replay_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that was written but not recorded runs again."""
    table, _, _ = _ingested_batches(spark, sf_dir, "batch-replay", stop_after=1)
    return _checked_telemetry(read_batches(spark, table), "malformed")


def batch_ledger_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that each batch's write observed, summed."""
    _, ledger, _ = _ingested_batches(spark, sf_dir, "batch-ledger")
    names = ("rows_written", "rows_malformed", "rows_untimed")
    return read_ledger(spark, ledger).agg((F.count(F.lit(1)) > 1).alias("several_batches"), *[F.sum(n).alias(n) for n in names])


def quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the texts of messages that could not be read in full."""
    _, _, quarantine = _ingested_batches(spark, sf_dir, "quarantine")
    return read_quarantine(spark, quarantine).select("malformed")


def deduplicated_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 / T2 with repeats dropped by one stateful pass: every message comes
    twice, each distinct reading stays once."""
    table, _, _ = _ingested_batches(spark, sf_dir, "deduplicated", typed=True, repeat=True)
    rows = read_batches(spark, table)
    return rows.select(F.col("signal_ts").cast("timestamp_ntz").alias("signal_ts"), *[reading(rows, k).alias(n) for n, k in zip(TYPED_COLUMNS, SIGNAL_KEYS)], "malformed")


def stream_restart_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpointed restart. Deliver the first part of the CSV rows and
    run both queries; run again with nothing new; deliver the rest and run
    again. One row per run with the rows it added to the table.

    Deliveries are Spark writes appended into the watched folder (files
    appear whole on commit), so no data passes through the driver.
    """
    run = new_scratch_dir(spark, "restart")
    inbox = f"{run}/inbox"
    topic = TopicConfig(path=f"{run}/topic")
    table = TableConfig(path=f"{run}/telemetry")
    events = read_events(spark, sf_dir)

    def deliver(rows: DataFrame) -> None:
        events_raw(rows).write.mode("append").option("header", True).csv(inbox)

    def cycle() -> int:
        publish_csv(spark, inbox, topic, f"{run}/checkpoint-producer")
        ingest_topic(spark, topic, table, f"{run}/checkpoint-subscriber")
        return read_table(spark, table).count()

    deliver(events.filter(~second_delivery()))
    total1 = cycle()
    total2 = cycle()
    deliver(events.filter(second_delivery()))
    total3 = cycle()
    rows = [(1, total1, total1), (2, total2 - total1, total2), (3, total3 - total2, total3)]
    return spark.createDataFrame(rows, "run int, rows_added bigint, total_rows bigint")


def telemetry_preview_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 on the table: its first rows in time order, signals looked up."""
    typed = typed_signals(load_telemetry(spark, sf_dir)).select("signal_date", "signal_ts", *TYPED_COLUMNS)
    return preview(typed, ["signal_ts", *TYPED_COLUMNS], PREVIEW_ROWS)


def telemetry_day_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + P8: one day of the table (a partition-pruned scan)."""
    day = load_telemetry(spark, sf_dir).filter(F.col("signal_date") == F.lit(PREDICT_DAY).cast("date"))
    return typed_signals(day).select("signal_date", "signal_ts", *TYPED_COLUMNS)


# ------------------------------------------------------------------- model
def _model_run(
    spark: SparkSession,
    sf_dir: str,
    split: str = "hash",
    exclude_day: str | None = None,
    engine: str = "moments",
) -> PowerModelRun:
    """Fitted anew for each query, so that it follows the data."""
    return train_and_evaluate(
        load_typed_telemetry(spark, sf_dir),
        split=split,
        train_fraction=TRAIN_FRACTION,
        exclude_day=exclude_day,
        persist=False,
        engine=engine,
        split_hash=SPLIT_HASH,
    )


def _round(df: DataFrame, decimals: int, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        *[F.col(c) if c in keep else F.round(c, decimals).alias(c) for c in df.columns]
    )


def power_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + P9 + M2: typed signals, rows with missing values dropped,
    features assembled (shown as their elements)."""
    arr = features_as_array(assemble(power_features(load_telemetry(spark, sf_dir))))
    return arr.select(
        "signal_date",
        "signal_ts",
        *[F.col("features")[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)],
        "active_power",
    )


def feature_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + M3b: rows read, rows kept after the null drop, train and test
    sizes of the layout-independent split, in one pass."""
    typed = typed_signals(load_telemetry(spark, sf_dir))
    complete = F.lit(True)
    for c in TYPED_COLUMNS:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(c)
    train = is_train(TRAIN_FRACTION, split_hash=SPLIT_HASH)
    return typed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(complete).alias("n_complete"),
        F.count_if(complete & train).alias("n_train"),
        F.count_if(complete & ~train).alias("n_test"),
    )


def power_model_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients and intercept from pyspark.ml LinearRegression."""
    return _round(coefficients_frame(_model_run(spark, sf_dir, engine="ml").model, spark), COEF_DECIMALS)


def power_model_moments_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 / C8 from one pass of covariance aggregates (same solution)."""
    return _round(coefficients_frame(_model_run(spark, sf_dir).model, spark), COEF_DECIMALS)


def model_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M6 + M7: LinearRegressionModel.transform on the held-out rows,
    RMSE and R^2."""
    run = _model_run(spark, sf_dir, engine="ml")
    return _round(regression_metrics(run.predictions), METRIC_DECIMALS, keep=("n",))


def model_metrics_moments_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M6 + M7 with the moments model (scoring as a column expression)."""
    return _round(regression_metrics(_model_run(spark, sf_dir).predictions), METRIC_DECIMALS, keep=("n",))


def model_metrics_random_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the reference's randomSplit(0.8/0.2, seed 42); rows depend on layout."""
    return regression_metrics(_model_run(spark, sf_dir, split="random", engine="ml").predictions)


def model_metrics_evaluator_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M7 through ``RegressionEvaluator``."""
    found = evaluate_with_evaluator(_model_run(spark, sf_dir, engine="ml").predictions)
    return _round(spark.createDataFrame([found], "rmse double, r2 double"), METRIC_DECIMALS)


def random_split_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the two sides of randomSplit hold every row once."""
    rows = power_features(load_typed_telemetry(spark, sf_dir))
    train, test = random_split(rows, (TRAIN_FRACTION, 1 - TRAIN_FRACTION))
    # Equal sums of a hash of each row, and equal counts: the same rows, as
    # often. Only two numbers a side are shuffled.
    own = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    parts = [df.select(own.alias("h"), F.lit(all_rows).alias("all_rows")) for df, all_rows in ((rows, True), (train, False), (test, False))]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = F.col("all_rows")
    sums = both.agg(F.count_if(whole).alias("n_rows"), F.count_if(~whole).alias("n_both_sides"), (F.sum(F.when(whole, F.col("h"))) != F.sum(F.when(~whole, F.col("h")))).alias("differ"))
    return sums.select("n_rows", "n_both_sides", F.coalesce(F.col("differ"), F.lit(False)).cast("bigint").alias("n_lost"))


def ingested_power_model_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages with the model: CSV -> topic -> table -> fit. The split
    hashes the wall clock that the ingest parsed."""
    telemetry = read_table(spark, _ingested_table(spark, sf_dir, "ingested-model"))
    telemetry = telemetry.withColumn("signal_ts", F.col("signal_ts").cast("timestamp_ntz"))
    run = train_and_evaluate(telemetry, train_fraction=TRAIN_FRACTION, split_hash=SPLIT_HASH)
    return _round(coefficients_frame(run.model, spark), COEF_DECIMALS)


def test_predictions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 / K5 / O1: held-out actual vs predicted, ordered by time."""
    series = actual_vs_predicted(_model_run(spark, sf_dir).predictions)
    return _round(series, VALUE_DECIMALS, keep=("signal_ts",)).orderBy("signal_ts", "active_power", "prediction")


def prediction_bounds_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of the actual-vs-predicted scatter."""
    return _round(chart_bounds(_model_run(spark, sf_dir).predictions), VALUE_DECIMALS)


def predict_day_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for one day, as the reference does it (the model
    was trained on a split that may include that day)."""
    model = _model_run(spark, sf_dir).model
    out = predict_day(model, power_features(load_typed_telemetry(spark, sf_dir)), PREDICT_DAY)
    return _round(out, VALUE_DECIMALS, keep=("signal_date", "signal_ts"))


def predict_day_saved_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 / M2, M4, M8 with a pipeline (assembler and regression) that was
    saved and loaded again."""
    features = power_features(load_typed_telemetry(spark, sf_dir))
    path = f"{new_scratch_dir(spark, 'model')}/pipeline"
    save_model(train_pipeline(features.filter(is_train(TRAIN_FRACTION, split_hash=SPLIT_HASH))), spark, path)
    out = predict_day(load_model(spark, path), features, PREDICT_DAY)
    return _round(out, VALUE_DECIMALS, keep=("signal_date", "signal_ts"))


def predict_day_holdout_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 with the predicted day kept out of training."""
    model = _model_run(spark, sf_dir, exclude_day=PREDICT_DAY).model
    out = predict_day(model, power_features(load_typed_telemetry(spark, sf_dir)), PREDICT_DAY)
    return _round(out, VALUE_DECIMALS, keep=("signal_date", "signal_ts"))


QUERIES: dict[str, Query] = {
    "hourly_generation": hourly_generation_q,
    "hourly_generation_typed": hourly_generation_typed_q,
    "hourly_generation_bucketed": hourly_generation_bucketed_q,
    "hourly_averages_avg": hourly_averages_avg_q,
    "daily_datapoints": daily_datapoints_q,
    "hourly_datapoints": hourly_datapoints_q,
    "daily_from_hourly": daily_from_hourly_q,
    "daily_datapoints_bitmap": daily_datapoints_bitmap_q,
    "hourly_datapoints_bitmap": hourly_datapoints_bitmap_q,
    "minutes_seen": minutes_seen_q,
    "hourly_long": hourly_long_q,
    "hourly_long_unpivot": hourly_long_unpivot_q,
    "hourly_long_renamed": hourly_long_renamed_q,
    "hourly_long_renamed_json": hourly_long_renamed_json_q,
    "hourly_preview": hourly_preview_q,
    "raw_csv_scan": raw_csv_scan_q,
    "raw_csv_scan_inferred": raw_csv_scan_inferred_q,
    "csv_inferred_to_topic": csv_inferred_to_topic_q,
    "message_roundtrip": message_roundtrip_q,
    "ingest_batch": ingest_batch_q,
    "csv_to_topic": csv_to_topic_q,
    "topic_to_table": topic_to_table_q,
    "ingested_hourly_generation": ingested_hourly_generation_q,
    "stream_restart": stream_restart_q,
    "csv_drift": csv_drift_q,
    "batch_ingest": batch_ingest_q,
    "batch_replay": batch_replay_q,
    "batch_ledger": batch_ledger_q,
    "quarantine": quarantine_q,
    "deduplicated_ingest": deduplicated_ingest_q,
    "telemetry_preview": telemetry_preview_q,
    "telemetry_day": telemetry_day_q,
    "power_features": power_features_q,
    "feature_counts": feature_counts_q,
    "power_model": power_model_q,
    "power_model_moments": power_model_moments_q,
    "model_metrics": model_metrics_q,
    "model_metrics_moments": model_metrics_moments_q,
    "model_metrics_random_split": model_metrics_random_split_q,
    "model_metrics_evaluator": model_metrics_evaluator_q,
    "random_split_counts": random_split_counts_q,
    "ingested_power_model": ingested_power_model_q,
    "test_predictions": test_predictions_q,
    "prediction_bounds": prediction_bounds_q,
    "predict_day": predict_day_q,
    "predict_day_saved": predict_day_saved_q,
    "predict_day_holdout": predict_day_holdout_q,
}
