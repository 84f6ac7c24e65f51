"""Analysis over the telemetry table: daily completeness, hourly averages,
generation band, long form, renamed signals.

Every function is DataFrame -> DataFrame, lazy, built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.functions.bands import generation_indicator
from sigflow.functions.signals import reading
from sigflow.functions.stats import slot_bitmap
from sigflow.operators.joins import MAX_BROADCAST_BYTES, join_dimension
from sigflow.schemas import AVG_COLUMNS, EXPECTED_PER_DAY, EXPECTED_PER_HOUR, SIGNAL_KEYS
from sigflow.sources.mapping import unique_mapping

LONG_COLUMNS = (
    "signal_date",
    "hour_of_day",
    "generation_indicator",
    "sig_name",
    "sig_mapping_name",
    "value",
)


def _completeness(counts: DataFrame, expected: int | None) -> DataFrame:
    if expected is None:
        return counts
    exp = F.lit(int(expected))
    return counts.withColumns(
        {
            "expected_count": exp,
            "missing_count": exp - F.col("distinct_ts_count"),
            "is_complete": F.col("distinct_ts_count") == exp,
        }
    )


def daily_datapoints(
    telemetry: DataFrame, expected_per_day: int | None = EXPECTED_PER_DAY
) -> DataFrame:
    """Distinct ``signal_ts`` per ``signal_date``, and completeness against the
    expected cadence (``missing_count`` is negative when a day has extra
    points).

    Planned as a partial aggregate on (date, ts), a shuffle on that pair and
    a count per date: a date holding most of the rows is still spread over
    many tasks by its timestamps. Duplicates do not inflate the count; a
    null ``signal_ts`` is not counted.
    """
    out = telemetry.groupBy("signal_date").agg(
        F.count_distinct("signal_ts").alias("distinct_ts_count")
    )
    return _completeness(out, expected_per_day)


def hourly_datapoints(
    telemetry: DataFrame, expected_per_hour: int | None = EXPECTED_PER_HOUR
) -> DataFrame:
    """Distinct ``signal_ts`` per (date, hour) and completeness against the
    expected cadence (6 per hour at 10 minutes). Same plan shape as
    ``daily_datapoints``, one group level finer."""
    counts = telemetry.groupBy("signal_date", F.hour("signal_ts").alias("hour_of_day")).agg(
        F.count_distinct("signal_ts").alias("distinct_ts_count")
    )
    return _completeness(counts, expected_per_hour)


def daily_from_hourly(
    hourly_counts: DataFrame, expected_per_day: int | None = EXPECTED_PER_DAY
) -> DataFrame:
    """``daily_datapoints`` from the output of ``hourly_datapoints``.

    Every timestamp has exactly one (date, hour) label, so the distinct
    count of a day is the sum of its hourly distinct counts. Deriving it
    this way needs no second (date, timestamp) shuffle: the work is one
    small aggregate over the hourly rows.
    """
    out = hourly_counts.groupBy("signal_date").agg(
        # Never null (a group has at least one hourly row); coalesce keeps
        # the column non-nullable like the count it replaces.
        F.coalesce(F.sum("distinct_ts_count"), F.lit(0).cast("bigint")).alias("distinct_ts_count")
    )
    return _completeness(out, expected_per_day)


def hourly_averages(telemetry: DataFrame) -> DataFrame:
    """Average of every signal per (date, hour), in one pass.

    Values come from the typed struct if the table has one, else they are
    looked up in the map and parsed; null, missing and unparsable values are
    skipped, NaN and duplicates weigh in. Wind direction is the arithmetic
    mean of degrees. Partial aggregation runs before the shuffle, so a hot
    hour costs one row per task, not one row per reading; a table bucketed by
    date and hour (``write_bucketed``) needs no shuffle.
    """
    hour = F.col("hour_of_day") if "hour_of_day" in telemetry.columns else F.hour("signal_ts")
    return telemetry.groupBy("signal_date", hour.alias("hour_of_day")).agg(
        *[F.avg(reading(telemetry, key)).alias(name) for key, name in zip(SIGNAL_KEYS, AVG_COLUMNS)]
    )


def with_generation_indicator(hourly: DataFrame, **band_kwargs) -> DataFrame:
    """Add ``generation_indicator`` from ``avg_active_power``."""
    return hourly.withColumn(
        "generation_indicator", generation_indicator(F.col("avg_active_power"), **band_kwargs)
    )


def hourly_generation(telemetry: DataFrame, **band_kwargs) -> DataFrame:
    return with_generation_indicator(hourly_averages(telemetry), **band_kwargs)


def minute_bitmaps(telemetry: DataFrame) -> DataFrame:
    """(signal_date, hour_of_day, slots): the minutes of the hour that have a
    reading, as a bitmap.

    For tables whose times are whole minutes on their date, as ingest writes
    them. There it stands for the distinct times exactly; a finer time, or one
    on another date, fails the query (use ``daily_datapoints``). What is
    shuffled is a bitmap per task, date and hour, in place of every distinct
    (date, time).
    """
    ts = F.col("signal_ts")
    whole = (F.date_trunc("minute", ts) == ts) & (F.to_date(ts) == F.col("signal_date"))
    error = F.raise_error(F.lit("a time is no whole minute of its date: count distinct times instead")).cast("int")
    minute = F.when(ts.isNull(), F.lit(None).cast("int")).when(whole, F.minute(ts)).otherwise(error)
    return telemetry.groupBy("signal_date", F.hour(ts).alias("hour_of_day")).agg(slot_bitmap(minute).alias("slots"))


def hourly_from_bitmaps(bitmaps: DataFrame, expected_per_hour: int | None = EXPECTED_PER_HOUR) -> DataFrame:
    """``hourly_datapoints`` from the output of ``minute_bitmaps``."""
    counts = bitmaps.select("signal_date", "hour_of_day", F.bitmap_count("slots").alias("distinct_ts_count"))
    return _completeness(counts, expected_per_hour)


def daily_from_bitmaps(bitmaps: DataFrame, expected_per_day: int | None = EXPECTED_PER_DAY) -> DataFrame:
    """``daily_datapoints`` from the output of ``minute_bitmaps``."""
    return daily_from_hourly(hourly_from_bitmaps(bitmaps, None), expected_per_day)


def slots_seen(bitmaps: DataFrame) -> DataFrame:
    """(hour_of_day, n_slots): how many of the hour's minutes have a reading
    on any date, from the same bitmaps."""
    seen = bitmaps.groupBy("hour_of_day").agg(F.bitmap_or_agg("slots").alias("slots"))
    return seen.select("hour_of_day", F.bitmap_count("slots").alias("n_slots"))


def to_long(hourly: DataFrame, method: str = "explode") -> DataFrame:
    """Wide hourly rows -> one row per signal (exactly four per hourly row,
    null averages included). A projection and a generator: no shuffle.

    ``method="explode"`` packs the averages into a map keyed by signal name
    and explodes it; ``method="unpivot"`` uses ``DataFrame.unpivot`` and
    names the signals from a literal lookup. Both give the same rows.
    """
    ids = ["signal_date", "hour_of_day", "generation_indicator"]
    if method == "unpivot":
        names = F.create_map(
            *[x for key, name in zip(SIGNAL_KEYS, AVG_COLUMNS) for x in (F.lit(name), F.lit(key))]
        )
        melted = hourly.unpivot(ids, list(AVG_COLUMNS), "avg_column", "value")
        return melted.select(*ids, names[F.col("avg_column")].alias("sig_name"), "value")
    if method != "explode":
        raise ValueError(f"unknown method {method!r}")
    metrics = F.create_map(
        *[x for key, name in zip(SIGNAL_KEYS, AVG_COLUMNS) for x in (F.lit(key), F.col(name))]
    )
    return hourly.select(*ids, F.explode(metrics).alias("sig_name", "value"))


def rename_signals(
    long: DataFrame,
    mapping: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    assume_unique: bool = False,
) -> DataFrame:
    """Left join of the long table with the signal-name dimension.

    The dimension is first made unique per ``sig_name`` (the task's JSON
    repeats a key), so the join cannot multiply rows; an unmapped signal
    keeps a null ``sig_mapping_name``. Pass ``assume_unique`` when that is
    already known (``mapping_frame`` guarantees it) to skip the aggregate.
    The dimension is broadcast behind a check of its bytes.
    """
    dim = mapping if assume_unique else unique_mapping(mapping)
    joined = join_dimension(
        long,
        dim,
        on="sig_name",
        how="left",
        max_broadcast_bytes=max_broadcast_bytes,
    )
    return joined.select(*LONG_COLUMNS)
