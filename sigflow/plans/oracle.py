"""DuckDB SQL for every registered query that SQL can express.

The driver registers the parquet tables as views; these statements restate
each query from ``events`` with the adapter rules of ``sources.testdata``
and the fixed parameters of ``plans.queries``.
"""

from __future__ import annotations

from sigflow.operators.model import split_threshold
from sigflow.plans.queries import PREDICT_DAY, PREVIEW_ROWS, TRAIN_FRACTION
from sigflow.plans.staging import SECOND_DELIVERY_FROM
from sigflow.sources.testdata import DAMAGED_EVERY
from sigflow.schemas import (
    ACTIVE_POWER,
    DATE_TIME,
    EXPECTED_PER_DAY,
    EXPECTED_PER_HOUR,
    SIGNAL_MAPPING,
    THEORETICAL_POWER,
    WIND_DIRECTION,
    WIND_SPEED,
)

_ACTIVE = "value * (hour(ts) + 1) * 2"
_SPEED = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) / 4"
_THEO = "CAST(user_id * 10.0 AS DOUBLE)"
_DIR = "CAST((event_id * 37) % 360 AS DOUBLE)"

TELEMETRY = f"""telemetry AS (
  SELECT CAST(ts AS DATE) AS signal_date, ts AS signal_ts,
         {_ACTIVE} AS active_power, {_SPEED} AS wind_speed,
         {_THEO} AS theoretical_curve, {_DIR} AS wind_direction
  FROM events)"""


# The same rows after the ingest stage: time parsed from minute-resolution text.
INGESTED_TELEMETRY = f"""telemetry AS (
  SELECT CAST(date_trunc('minute', ts) AS DATE) AS signal_date, date_trunc('minute', ts) AS signal_ts,
         {_ACTIVE} AS active_power, {_SPEED} AS wind_speed,
         {_THEO} AS theoretical_curve, {_DIR} AS wind_direction
  FROM events)"""


HOURLY = f"""hourly AS (
  SELECT signal_date, CAST(hour(signal_ts) AS INTEGER) AS hour_of_day,
         AVG(active_power) AS avg_active_power,
         AVG(wind_speed) AS avg_wind_speed,
         AVG(theoretical_curve) AS avg_theoretical_power_curve,
         AVG(wind_direction) AS avg_wind_direction
  FROM telemetry GROUP BY 1, 2),
gen AS (
  SELECT *, CASE
      WHEN avg_active_power < 200 THEN 'Low'
      WHEN avg_active_power >= 200 AND avg_active_power < 600 THEN 'Medium'
      WHEN avg_active_power >= 600 AND avg_active_power < 1000 THEN 'High'
      ELSE 'Exceptional' END AS generation_indicator
  FROM hourly),
rounded AS (
  SELECT signal_date, hour_of_day, generation_indicator, ROUND(avg_active_power, 6) AS avg_active_power,
         ROUND(avg_wind_speed, 6) AS avg_wind_speed,
         ROUND(avg_theoretical_power_curve, 6) AS avg_theoretical_power_curve,
         ROUND(avg_wind_direction, 6) AS avg_wind_direction
  FROM gen)"""


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LONG = "long AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT signal_date, hour_of_day, generation_indicator, {_sql_str(key)} AS sig_name, {col} AS value FROM rounded"
    for key, col in (
        (ACTIVE_POWER, "avg_active_power"),
        (WIND_SPEED, "avg_wind_speed"),
        (THEORETICAL_POWER, "avg_theoretical_power_curve"),
        (WIND_DIRECTION, "avg_wind_direction"),
    )
) + ")"

MAPPING = "mapping(sig_name, sig_mapping_name) AS (VALUES " + ", ".join(
    f"({_sql_str(k)}, {_sql_str(v)})" for k, v in SIGNAL_MAPPING
) + ")"

RAW_SELECT = f"""SELECT strftime(ts, '%d %m %Y %H:%M') AS "{DATE_TIME}",
       {_ACTIVE} AS "{ACTIVE_POWER}",
       {_SPEED} AS "{WIND_SPEED}",
       {_THEO} AS "{THEORETICAL_POWER}",
       {_DIR} AS "{WIND_DIRECTION}"
FROM events"""

INGESTED_SELECT = f"""SELECT CAST(date_trunc('minute', ts) AS DATE) AS signal_date,
       date_trunc('minute', ts) AS signal_ts,
       true AS has_create_date, true AS has_create_ts,
       {_ACTIVE} AS active_power, {_SPEED} AS wind_speed,
       {_THEO} AS theoretical_curve, {_DIR} AS wind_direction
FROM events"""

_COMPLETE = " AND ".join(
    f"{c} IS NOT NULL AND NOT isnan({c})"
    for c in ("active_power", "wind_speed", "theoretical_curve", "wind_direction")
)
_TRAIN = (
    f"coalesce(substr(md5(CAST(signal_ts AS VARCHAR)), 1, 4) < '{split_threshold(TRAIN_FRACTION)}', "
    "signal_ts IS NULL)"
)

FEATURES = f"""features AS (
  SELECT signal_date, signal_ts, wind_speed, theoretical_curve, wind_direction, active_power,
         {_TRAIN} AS is_train
  FROM telemetry WHERE {_COMPLETE})"""


def _fit(name: str, where: str) -> str:
    """Least squares with intercept on three features, by Cramer's rule on
    the population covariance matrix."""
    x = ("wind_speed", "theoretical_curve", "wind_direction")
    return f"""{name}_m AS (
  SELECT covar_pop({x[0]}, {x[0]}) AS a11, covar_pop({x[0]}, {x[1]}) AS a12, covar_pop({x[0]}, {x[2]}) AS a13,
         covar_pop({x[1]}, {x[1]}) AS a22, covar_pop({x[1]}, {x[2]}) AS a23, covar_pop({x[2]}, {x[2]}) AS a33,
         covar_pop({x[0]}, active_power) AS b1, covar_pop({x[1]}, active_power) AS b2,
         covar_pop({x[2]}, active_power) AS b3,
         avg({x[0]}) AS m1, avg({x[1]}) AS m2, avg({x[2]}) AS m3, avg(active_power) AS my
  FROM features WHERE {where}),
{name}_d AS (
  SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det
  FROM {name}_m),
{name}_w AS (
  SELECT (b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3)) / det AS w1,
         (a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13)) / det AS w2,
         (a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13)) / det AS w3,
         m1, m2, m3, my
  FROM {name}_d),
{name} AS (
  SELECT w1, w2, w3, my - w1 * m1 - w2 * m2 - w3 * m3 AS b0 FROM {name}_w)"""


def _predict(model: str) -> str:
    return (
        f"(SELECT b0 FROM {model}) + (SELECT w1 FROM {model}) * wind_speed"
        f" + (SELECT w2 FROM {model}) * theoretical_curve + (SELECT w3 FROM {model}) * wind_direction"
    )


MODEL = _fit("model", "is_train")
TEST_PRED = f"""test_pred AS (
  SELECT signal_date, signal_ts, active_power, {_predict('model')} AS prediction
  FROM features WHERE NOT is_train)"""

_DAY = f"DATE '{PREDICT_DAY}'"


def _day_predictions(model: str) -> str:
    return f"""SELECT signal_date, signal_ts, round(active_power, 2) AS active_power,
       round({_predict(model)}, 2) AS prediction
FROM features WHERE signal_date = {_DAY}"""


# Messages with damage: which kind, and the text.
_KIND = f"CASE WHEN event_id % {DAMAGED_EVERY} = 0 THEN (event_id // {DAMAGED_EVERY}) % 3 END"
_BAD_TEXT = f"""CASE {_KIND}
  WHEN 0 THEN '{{"Date/Time":"01 01 2024 00:00","row_id":' || event_id
  WHEN 1 THEN '{{"Date/Time":"01 01 2024 00:00","Wind Speed (m/s)":"calm","row_id":' || event_id || '}}'
  WHEN 2 THEN '{{"Date/Time":"31 02 2024 00:00","row_id":' || event_id || '}}' END"""
_BATCHES = f"""SELECT CAST(signal_ts AS DATE) AS signal_date, signal_ts, true AS has_create_date, true AS has_create_ts,
       CASE WHEN kind IS NULL THEN active_power END AS active_power, CASE WHEN kind IS NULL THEN wind_speed END AS wind_speed,
       CASE WHEN kind IS NULL THEN theoretical_curve END AS theoretical_curve,
       CASE WHEN kind IS NULL THEN wind_direction END AS wind_direction, malformed
FROM (
  SELECT CASE {_KIND} WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP '2024-01-01 00:00:00' WHEN 2 THEN NULL
         ELSE date_trunc('minute', ts) END AS signal_ts,
         {_ACTIVE} AS active_power, {_SPEED} AS wind_speed, {_THEO} AS theoretical_curve, {_DIR} AS wind_direction,
         {_KIND} AS kind, {_BAD_TEXT} AS malformed
  FROM events)"""


def _restart() -> str:
    first = f"ts < TIMESTAMP '{SECOND_DELIVERY_FROM}' OR ts IS NULL"
    return f"""WITH c AS (
  SELECT COUNT(*) FILTER (WHERE {first}) AS n1, COUNT(*) AS n FROM events)
SELECT 1 AS run, n1 AS rows_added, n1 AS total_rows FROM c
UNION ALL SELECT 2, CAST(0 AS BIGINT), n1 FROM c
UNION ALL SELECT 3, n - n1, n FROM c"""


ORACLE_SQL: dict[str, str] = {
    "hourly_averages_avg": f"""WITH {TELEMETRY}
SELECT signal_date, CAST(hour(signal_ts) AS INTEGER) AS hour_of_day,
       ROUND(AVG(active_power), 6) AS avg_active_power, ROUND(AVG(wind_speed), 6) AS avg_wind_speed,
       ROUND(AVG(theoretical_curve), 6) AS avg_theoretical_power_curve, ROUND(AVG(wind_direction), 6) AS avg_wind_direction
FROM telemetry GROUP BY 1, 2""",
    "hourly_generation_typed": f"WITH {TELEMETRY},\n{HOURLY}\nSELECT * FROM rounded",
    "hourly_generation_bucketed": f"WITH {TELEMETRY},\n{HOURLY}\nSELECT * FROM rounded",
    "hourly_generation": f"WITH {TELEMETRY},\n{HOURLY}\nSELECT * FROM rounded",
    "daily_datapoints": f"""WITH {TELEMETRY}
SELECT signal_date, COUNT(DISTINCT signal_ts) AS distinct_ts_count,
       {EXPECTED_PER_DAY} AS expected_count,
       {EXPECTED_PER_DAY} - COUNT(DISTINCT signal_ts) AS missing_count,
       COUNT(DISTINCT signal_ts) = {EXPECTED_PER_DAY} AS is_complete
FROM telemetry GROUP BY signal_date""",
    "daily_datapoints_bitmap": f"""WITH {INGESTED_TELEMETRY}
SELECT signal_date, COUNT(DISTINCT signal_ts) AS distinct_ts_count,
       {EXPECTED_PER_DAY} AS expected_count,
       {EXPECTED_PER_DAY} - COUNT(DISTINCT signal_ts) AS missing_count,
       COUNT(DISTINCT signal_ts) = {EXPECTED_PER_DAY} AS is_complete
FROM telemetry GROUP BY signal_date""",
    "hourly_datapoints_bitmap": f"""WITH {INGESTED_TELEMETRY}
SELECT signal_date, CAST(hour(signal_ts) AS INTEGER) AS hour_of_day,
       COUNT(DISTINCT signal_ts) AS distinct_ts_count,
       {EXPECTED_PER_HOUR} AS expected_count,
       {EXPECTED_PER_HOUR} - COUNT(DISTINCT signal_ts) AS missing_count,
       COUNT(DISTINCT signal_ts) = {EXPECTED_PER_HOUR} AS is_complete
FROM telemetry GROUP BY 1, 2""",
    "minutes_seen": f"""WITH {INGESTED_TELEMETRY}
SELECT CAST(hour(signal_ts) AS INTEGER) AS hour_of_day, COUNT(DISTINCT minute(signal_ts)) AS n_slots
FROM telemetry GROUP BY 1""",
    "daily_from_hourly": f"""WITH {TELEMETRY}
SELECT signal_date, COUNT(DISTINCT signal_ts) AS distinct_ts_count,
       {EXPECTED_PER_DAY} AS expected_count,
       {EXPECTED_PER_DAY} - COUNT(DISTINCT signal_ts) AS missing_count,
       COUNT(DISTINCT signal_ts) = {EXPECTED_PER_DAY} AS is_complete
FROM telemetry GROUP BY signal_date""",
    "hourly_datapoints": f"""WITH {TELEMETRY}
SELECT signal_date, CAST(hour(signal_ts) AS INTEGER) AS hour_of_day,
       COUNT(DISTINCT signal_ts) AS distinct_ts_count,
       {EXPECTED_PER_HOUR} AS expected_count,
       {EXPECTED_PER_HOUR} - COUNT(DISTINCT signal_ts) AS missing_count,
       COUNT(DISTINCT signal_ts) = {EXPECTED_PER_HOUR} AS is_complete
FROM telemetry GROUP BY 1, 2""",
    "hourly_long": f"WITH {TELEMETRY},\n{HOURLY},\n{LONG}\nSELECT * FROM long",
    "hourly_long_unpivot": f"WITH {TELEMETRY},\n{HOURLY},\n{LONG}\nSELECT * FROM long",
    "hourly_long_renamed": f"""WITH {TELEMETRY},\n{HOURLY},\n{LONG},\n{MAPPING}
SELECT l.signal_date, l.hour_of_day, l.generation_indicator, l.sig_name, m.sig_mapping_name, l.value
FROM long l LEFT JOIN mapping m ON l.sig_name = m.sig_name""",
    "hourly_long_renamed_json": f"""WITH {TELEMETRY},\n{HOURLY},\n{LONG},\n{MAPPING}
SELECT l.signal_date, l.hour_of_day, l.generation_indicator, l.sig_name, m.sig_mapping_name, l.value
FROM long l LEFT JOIN mapping m ON l.sig_name = m.sig_name""",
    "hourly_preview": f"""WITH {TELEMETRY},\n{HOURLY}
SELECT * FROM rounded ORDER BY signal_date, hour_of_day LIMIT {PREVIEW_ROWS}""",
    "raw_csv_scan": RAW_SELECT,
    "raw_csv_scan_inferred": RAW_SELECT,
    "csv_inferred_to_topic": RAW_SELECT,
    "message_roundtrip": RAW_SELECT,
    "csv_to_topic": RAW_SELECT,
    "csv_drift": RAW_SELECT,
    "ingest_batch": INGESTED_SELECT,
    "topic_to_table": INGESTED_SELECT,
    "ingested_hourly_generation": f"WITH {INGESTED_TELEMETRY},\n{HOURLY}\nSELECT * FROM rounded",
    "stream_restart": _restart(),
    "batch_ingest": _BATCHES,
    "batch_replay": _BATCHES,
    "batch_ledger": f"""SELECT true AS several_batches, COUNT(*) AS rows_written,
       COUNT({_BAD_TEXT}) AS rows_malformed, COUNT(*) FILTER (WHERE {_KIND} IN (0, 2) OR ts IS NULL) AS rows_untimed
FROM events""",
    "quarantine": f"SELECT {_BAD_TEXT} AS malformed FROM events WHERE {_BAD_TEXT} IS NOT NULL",
    "deduplicated_ingest": f"""SELECT DISTINCT signal_ts, active_power, wind_speed, theoretical_curve, wind_direction, malformed
FROM ({_BATCHES})""",
    "telemetry_preview": f"""WITH {TELEMETRY}
SELECT signal_date, signal_ts, active_power, wind_speed, theoretical_curve, wind_direction
FROM telemetry
ORDER BY signal_ts, active_power, wind_speed, theoretical_curve, wind_direction LIMIT {PREVIEW_ROWS}""",
    "telemetry_day": f"""WITH {TELEMETRY}
SELECT signal_date, signal_ts, active_power, wind_speed, theoretical_curve, wind_direction
FROM telemetry WHERE signal_date = {_DAY}""",
    "power_features": f"""WITH {TELEMETRY},\n{FEATURES}
SELECT signal_date, signal_ts, wind_speed, theoretical_curve, wind_direction, active_power FROM features""",
    "feature_counts": f"""WITH {TELEMETRY},
flags AS (SELECT ({_COMPLETE}) AS complete, {_TRAIN} AS train FROM telemetry)
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE complete) AS n_complete,
       COUNT(*) FILTER (WHERE complete AND train) AS n_train,
       COUNT(*) FILTER (WHERE complete AND NOT train) AS n_test
FROM flags""",
    "power_model": f"""WITH {TELEMETRY},\n{FEATURES},\n{MODEL}
SELECT round(w1, 6) AS coef_wind_speed, round(w2, 6) AS coef_theoretical_curve,
       round(w3, 6) AS coef_wind_direction, round(b0, 6) AS intercept
FROM model""",
    "model_metrics": f"""WITH {TELEMETRY},\n{FEATURES},\n{MODEL},\n{TEST_PRED}
SELECT COUNT(*) AS n,
       round(sqrt(SUM((prediction - active_power) * (prediction - active_power)) / COUNT(*)), 6) AS rmse,
       round(1 - SUM((prediction - active_power) * (prediction - active_power))
                 / (var_pop(active_power) * COUNT(*)), 6) AS r2
FROM test_pred""",
    "power_model_moments": f"""WITH {TELEMETRY},\n{FEATURES},\n{MODEL}
SELECT round(w1, 6) AS coef_wind_speed, round(w2, 6) AS coef_theoretical_curve,
       round(w3, 6) AS coef_wind_direction, round(b0, 6) AS intercept
FROM model""",
    "model_metrics_moments": f"""WITH {TELEMETRY},\n{FEATURES},\n{MODEL},\n{TEST_PRED}
SELECT COUNT(*) AS n,
       round(sqrt(SUM((prediction - active_power) * (prediction - active_power)) / COUNT(*)), 6) AS rmse,
       round(1 - SUM((prediction - active_power) * (prediction - active_power))
                 / (var_pop(active_power) * COUNT(*)), 6) AS r2
FROM test_pred""",
    "model_metrics_evaluator": f"""WITH {TELEMETRY},\n{FEATURES},\n{MODEL},\n{TEST_PRED}
SELECT round(sqrt(SUM((prediction - active_power) * (prediction - active_power)) / COUNT(*)), 6) AS rmse,
       round(1 - SUM((prediction - active_power) * (prediction - active_power))
                 / (var_pop(active_power) * COUNT(*)), 6) AS r2
FROM test_pred""",
    "random_split_counts": f"""WITH {TELEMETRY},\n{FEATURES}
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_both_sides, CAST(0 AS BIGINT) AS n_lost FROM features""",
    "ingested_power_model": f"""WITH {INGESTED_TELEMETRY},\n{FEATURES},\n{MODEL}
SELECT round(w1, 6) AS coef_wind_speed, round(w2, 6) AS coef_theoretical_curve,
       round(w3, 6) AS coef_wind_direction, round(b0, 6) AS intercept
FROM model""",
    "test_predictions": f"""WITH {TELEMETRY},\n{FEATURES},\n{MODEL},\n{TEST_PRED}
SELECT signal_ts, round(active_power, 2) AS active_power, round(prediction, 2) AS prediction,
       round(prediction - active_power, 2) AS residual
FROM test_pred ORDER BY signal_ts, active_power, prediction""",
    "prediction_bounds": f"""WITH {TELEMETRY},\n{FEATURES},\n{MODEL},\n{TEST_PRED}
SELECT round(MIN(least(active_power, prediction)), 2) AS min_val,
       round(MAX(greatest(active_power, prediction)), 2) AS max_val
FROM test_pred""",
    "predict_day": f"WITH {TELEMETRY},\n{FEATURES},\n{MODEL}\n{_day_predictions('model')}",
    "predict_day_saved": f"WITH {TELEMETRY},\n{FEATURES},\n{MODEL}\n{_day_predictions('model')}",
    "predict_day_holdout": f"""WITH {TELEMETRY},\n{FEATURES},\n{_fit('holdout', f'is_train AND signal_date IS DISTINCT FROM {_DAY}')}
{_day_predictions('holdout')}""",
}
