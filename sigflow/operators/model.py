"""Active-power regression: features, split, fit, score, evaluate, predict a day.

Two fitting engines reach the same least-squares solution in one distributed
pass each: ``fit_least_squares`` (means and covariances as DataFrame
aggregates, prediction as a column expression) and ``pyspark.ml``'s
LinearRegression (vector column, normal equation). Only a handful of numbers
reach the driver. Metrics are plain aggregates, so RMSE and R^2 come from
one pass.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.functions.signals import reading
from sigflow.schemas import FEATURE_COLUMNS, LABEL_COLUMN, SIGNAL_KEYS, TYPED_COLUMNS
from sigflow.session import path_exists

#: Directions of the features with less than this share of the largest
#: variance (after scaling) count as rounding errors.
COLLINEAR = 1e-12


def typed_signals(telemetry: DataFrame) -> DataFrame:
    """One double column per signal (null when missing or unparsable), from
    the typed struct if the table has one, else from the map."""
    return telemetry.withColumns({name: reading(telemetry, key) for name, key in zip(TYPED_COLUMNS, SIGNAL_KEYS)})


def keep_complete(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows whose ``values`` are all present (not null, not NaN); same rows
    as ``dropna(subset=values)``.

    ``dropna`` is a filter, and Catalyst moves filters below the projection
    that computes the values, so each parse would run twice per row (once
    in the filter, once in the projection). Here the values are computed
    once and a row is emitted through ``inline`` of a one-element (or empty)
    array. Filters on ``keys`` still move down past the generator to the
    scan, so partition pruning is kept. Measured: 42% less time per pass.
    """
    ok = F.lit(True)
    for c in values:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    row = F.array(F.struct(*[F.col(c) for c in values]))
    return df.select(*keys, F.inline(F.when(ok, row).otherwise(F.array())))


def power_features(telemetry: DataFrame, drop_missing: bool = True) -> DataFrame:
    """Typed label and features; rows with a null or NaN in any of them are
    dropped (the model cannot use them)."""
    typed = typed_signals(telemetry).select("signal_date", "signal_ts", *TYPED_COLUMNS)
    if not drop_missing:
        return typed
    return keep_complete(typed, ["signal_date", "signal_ts"], TYPED_COLUMNS)


def assemble(features: DataFrame, feature_cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Feature columns -> one ``features`` vector (wind speed, theoretical
    curve, wind direction)."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features")
    return assembler.transform(features).select("signal_date", "signal_ts", "features", LABEL_COLUMN)


def features_as_array(assembled: DataFrame) -> DataFrame:
    """The vector column as ``array<double>`` (comparable outside Spark ML)."""
    return assembled.withColumn("features", vector_to_array("features"))


def split_bucket(key: str = "signal_ts") -> Column:
    """Four hex digits of md5 over the key's text: a uniform bucket in
    [0000, ffff] that depends only on the row, not on partition layout or
    the session's time zone. The text of a time without zone is the plain
    cast (``2024-01-01 00:00:07.1795``), which costs less than a pattern
    format and reads the same in other engines; a ``timestamp`` is an
    instant, whose text depends on the zone, so its microseconds are used."""
    instant = F.unix_micros(F.col(key).cast("timestamp")).cast("string")
    text = F.when(F.typeof(F.col(key)) == "timestamp", instant).otherwise(F.col(key).cast("string"))
    return F.substring(F.md5(text), 1, 4)


def split_threshold(fraction: float) -> str:
    """Bucket bound for a training share: buckets below it train."""
    return format(min(65536, max(0, round(fraction * 65536))), "04x") if fraction < 1 else "~"


def is_train(fraction: float = 0.8, key: str = "signal_ts", split_hash: str = "xxhash64") -> Column:
    """True for the training side of a layout-independent split.

    ``split_hash="xxhash64"`` (default) hashes the value itself (no text,
    JVM-native); ``"md5"`` hashes the value's text and can be reproduced by
    any engine with md5 (the registered queries use it so that the SQL
    oracle can check the split). Measured on 10M rows: fit 6.1 s vs 15.1 s,
    held-out metrics 2.9 s vs 10.0 s.
    """
    if split_hash == "md5":
        flag = split_bucket(key) < F.lit(split_threshold(fraction))
    elif split_hash == "xxhash64":
        bound = min(65536, max(0, round(fraction * 65536)))
        flag = F.pmod(F.xxhash64(key), F.lit(65536)) < F.lit(bound)
    else:
        raise ValueError(f"unknown split hash {split_hash!r}")
    # A row without a key (time text that did not parse) trains, so that no
    # row falls out of both sides.
    return F.coalesce(flag, F.col(key).isNull())


def hash_split(
    df: DataFrame, fraction: float = 0.8, key: str = "signal_ts", split_hash: str = "xxhash64"
) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split: the same rows at any partitioning.
    Equal keys land on the same side; rows without a key train. The two
    sides together hold every row."""
    flag = is_train(fraction, key, split_hash)
    return df.filter(flag), df.filter(~flag)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` as the reference does it; the rows chosen depend on the
    partition layout even with a fixed seed."""
    return df.randomSplit(list(weights), seed=seed)


def train_power_model(
    train: DataFrame,
    max_iter: int = 50,
    reg_param: float = 0.0,
    elastic_net_param: float = 0.0,
) -> LinearRegressionModel:
    """Least-squares fit of active power on the three features (intercept on).
    With no regularisation the solver is the normal equation, so
    ``max_iter`` has no effect."""
    lr = LinearRegression(
        featuresCol="features",
        labelCol=LABEL_COLUMN,
        maxIter=max_iter,
        regParam=reg_param,
        elasticNetParam=elastic_net_param,
    )
    return lr.fit(train)


def train_pipeline(features: DataFrame, feature_cols: Sequence[str] = FEATURE_COLUMNS) -> PipelineModel:
    """Assembler and regression as one ``pyspark.ml`` pipeline, fitted on
    typed features (``power_features``). It scores typed features by itself,
    saved and loaded too."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features")
    return Pipeline(stages=[assembler, LinearRegression(featuresCol="features", labelCol=LABEL_COLUMN, maxIter=50)]).fit(features)


def as_pipeline(model: LinearRegressionModel, feature_cols: Sequence[str] = FEATURE_COLUMNS) -> PipelineModel:
    """A fitted regression with the assembler before it, as one model."""
    return PipelineModel([VectorAssembler(inputCols=list(feature_cols), outputCol="features"), model])


def save_model(model, spark, path: str) -> None:
    """Write a fitted model of any kind; ``load_model`` reads it."""
    if isinstance(model, LeastSquaresModel):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark, path: str):
    """A model that ``save_model`` wrote: a pipeline, a regression model or a
    ``LeastSquaresModel``, told apart by what is in the folder."""
    if not path_exists(spark, f"{path}/metadata"):
        return LeastSquaresModel.load(spark, path)
    kind = spark.read.json(f"{path}/metadata").first()["class"]
    return (PipelineModel if kind.endswith("PipelineModel") else LinearRegressionModel).load(path)


def score(model, rows: DataFrame) -> DataFrame:
    """Append ``prediction``; the model (four numbers) travels with the tasks.
    A ``LinearRegressionModel`` needs assembled rows (assembled here when
    they are not); a pipeline or a ``LeastSquaresModel`` reads the feature
    columns."""
    if isinstance(model, (LeastSquaresModel, PipelineModel)):
        return model.transform(rows)
    if "features" not in rows.columns:
        rows = assemble(rows)
    return model.transform(rows)


@dataclass(frozen=True)
class LeastSquaresModel:
    """Linear model fitted from moments: ``intercept + sum(w_i * x_i)``.

    Scoring is a plain column expression (whole-stage codegen, no vector
    column, no UDF); the model is a handful of literals in the plan.
    """

    coefficients: tuple[float, ...]
    intercept: float
    feature_cols: tuple[str, ...] = FEATURE_COLUMNS

    def prediction(self) -> Column:
        expr = None
        for w, c in zip(self.coefficients, self.feature_cols):
            term = F.lit(float(w)) * F.col(c)
            expr = term if expr is None else expr + term
        return expr + F.lit(float(self.intercept))

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", self.prediction())

    def save(self, spark, path: str) -> None:
        """One-row table: ``coef_<feature>`` columns and ``intercept``."""
        coefficients_frame(self, spark, self.feature_cols).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "LeastSquaresModel":
        row = spark.read.parquet(path).first()
        names = [c for c in row.asDict() if c.startswith("coef_")]
        return cls(tuple(float(row[c]) for c in names), float(row["intercept"]), tuple(c[5:] for c in names))


def fit_least_squares(
    train: DataFrame,
    feature_cols: Sequence[str] = FEATURE_COLUMNS,
    label: str = LABEL_COLUMN,
) -> LeastSquaresModel:
    """Ordinary least squares with intercept, from one aggregate pass.

    The pass computes means and the population covariances of features and
    label (numerically stable merges of per-partition moments); only those
    few numbers reach the driver, which solves the small system
    ``Cov(X, X) w = Cov(X, y)``, intercept ``mean(y) - w . mean(X)``. This
    is the solution LinearRegression's normal-equation solver gives without
    regularisation, at a fraction of the per-row cost. The system is scaled
    to correlations first; a constant feature gets the weight 0, and collinear
    ones the solution of least norm in the scaled weights.
    """
    import numpy as np

    cols = list(feature_cols) + [label]
    k = len(feature_cols)
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [
        F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}")
        for i in range(k + 1)
        for j in range(i, k + 1)
        if i < k
    ]
    row = train.agg(*aggs).first()
    if row is None or row["m0"] is None:
        raise ValueError("no training rows")
    a = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], dtype=float)
    b = np.array([row[f"c{i}_{k}"] for i in range(k)], dtype=float)
    scale = np.sqrt(np.diag(a))
    scale[scale == 0] = 1.0
    w = np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=COLLINEAR)[0] / scale
    intercept = row[f"m{k}"] - float(np.dot(w, [row[f"m{i}"] for i in range(k)]))
    return LeastSquaresModel(tuple(float(x) for x in w), float(intercept), tuple(feature_cols))


def coefficients_frame(model, spark, feature_cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """The fitted model as one row: ``coef_<feature>`` and ``intercept``."""
    coefs = model.coefficients if isinstance(model, LeastSquaresModel) else model.coefficients.toArray()
    values = [float(c) for c in coefs] + [float(model.intercept)]
    names = [f"coef_{c}" for c in feature_cols] + ["intercept"]
    return spark.createDataFrame([tuple(values)], names)


def _error_sums(label: str, prediction: str) -> list[Column]:
    err = F.col(prediction) - F.col(label)
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("sse"),
        F.var_pop(label).alias("var_y"),
    ]


def _metric_columns() -> list[Column]:
    """n, rmse, r2 from ``_error_sums``. For a constant label r2 is what the
    evaluator gives: -infinity, or NaN without any error; both metrics of an
    empty set are null."""
    total = F.col("var_y") * F.col("n")
    constant = F.when(F.col("sse") > 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    r2 = F.when(total == 0, constant).otherwise(F.lit(1.0) - F.try_divide(F.col("sse"), total))
    return ["n", F.sqrt(F.try_divide(F.col("sse"), F.col("n"))).alias("rmse"), r2.alias("r2")]


def regression_metrics(
    predictions: DataFrame, label: str = LABEL_COLUMN, prediction: str = "prediction"
) -> DataFrame:
    """One row: ``n``, ``rmse`` and ``r2`` from a single aggregate pass.

    rmse = sqrt(SSE / n); r2 = 1 - SSE / SST with SST = n * var_pop(label)
    (the same definitions as RegressionEvaluator).
    """
    return predictions.agg(*_error_sums(label, prediction)).select(*_metric_columns())


def evaluation_summary(
    predictions: DataFrame, label: str = LABEL_COLUMN, prediction: str = "prediction"
) -> DataFrame:
    """``regression_metrics`` and ``chart_bounds`` from one aggregate pass:
    n, rmse, r2, min_val, max_val."""
    agg = predictions.agg(
        *_error_sums(label, prediction),
        F.min(F.least(label, prediction)).alias("min_val"),
        F.max(F.greatest(label, prediction)).alias("max_val"),
    )
    return agg.select(*_metric_columns(), "min_val", "max_val")


def evaluate_with_evaluator(predictions: DataFrame) -> tuple[float, float]:
    """RMSE and R^2 through ``RegressionEvaluator`` (two passes)."""
    from pyspark.ml.evaluation import RegressionEvaluator

    ev = RegressionEvaluator(labelCol=LABEL_COLUMN, predictionCol="prediction")
    return ev.setMetricName("rmse").evaluate(predictions), ev.setMetricName("r2").evaluate(predictions)


def day_literal(day: str | _dt.date) -> Column:
    return F.lit(str(day)).cast("date")


def predict_day(model, rows: DataFrame, day: str | _dt.date) -> DataFrame:
    """Predictions for one calendar day in time order: actual and predicted
    power.

    ``rows`` are typed features (``power_features``) or already assembled
    rows. The day filter is applied before any vector assembly (the
    assembler's projection stops filters from moving down), so on a table
    partitioned by ``signal_date`` only that day's folder is read.
    """
    rows = rows.filter(F.col("signal_date") == day_literal(day))
    out = score(model, rows).select("signal_date", "signal_ts", LABEL_COLUMN, "prediction")
    return out.orderBy("signal_ts", LABEL_COLUMN, "prediction")


def actual_vs_predicted(predictions: DataFrame) -> DataFrame:
    """Chart series ordered by time, with the residual (prediction - actual).

    A distributed sort (range partitioning), never a collect. The values are
    tie-breakers in the sort key, so many rows sharing one timestamp (a
    replayed batch, say) are still cut into several ranges.
    """
    return predictions.select(
        "signal_ts",
        LABEL_COLUMN,
        "prediction",
        (F.col("prediction") - F.col(LABEL_COLUMN)).alias("residual"),
    ).orderBy("signal_ts", LABEL_COLUMN, "prediction")


def chart_bounds(predictions: DataFrame) -> DataFrame:
    """Bounds of the y = x reference line: min and max over actual and
    predicted values together."""
    return predictions.agg(
        F.min(F.least(LABEL_COLUMN, "prediction")).alias("min_val"),
        F.max(F.greatest(LABEL_COLUMN, "prediction")).alias("max_val"),
    )


@dataclass
class PowerModelRun:
    model: "LinearRegressionModel | LeastSquaresModel"
    features: DataFrame
    train: DataFrame
    test: DataFrame
    predictions: DataFrame

    def metrics(self) -> DataFrame:
        return regression_metrics(self.predictions)


def train_and_evaluate(
    telemetry: DataFrame,
    split: str = "hash",
    train_fraction: float = 0.8,
    seed: int = 42,
    exclude_day: str | _dt.date | None = None,
    persist: bool = False,
    engine: str = "moments",
    split_hash: str = "xxhash64",
    features: DataFrame | None = None,
) -> PowerModelRun:
    """Features -> split -> fit -> score the held-out rows.

    ``features`` are the rows of ``power_features(telemetry)``, if they are
    there already (a written table, say).

    ``engine="moments"`` fits from one pass of covariance aggregates and
    scores with a column expression (``fit_least_squares``);
    ``engine="ml"`` assembles vectors and uses ``LinearRegression`` (a
    ``pyspark.ml`` model that can be saved and reloaded). Both give the same
    coefficients to about 1e-12.

    ``split="hash"`` is layout independent (``split_hash`` picks md5 or
    xxhash64, see ``is_train``); ``"random"`` is the reference's
    ``randomSplit([f, 1 - f], seed)``. ``exclude_day`` keeps one day out of
    training so that predicting it is not scored on rows the model saw.
    Filters run on the typed columns, before any assembly, so they stay
    close to the scan.

    ``persist`` keeps the typed feature rows (four doubles, a date and a
    time) in memory and disk for the fit and the later passes instead of
    re-reading the map column; lost blocks are rebuilt from lineage. Leave
    it off when those rows do not fit the cluster's memory and local disks:
    each pass is then one more column-pruned scan.
    """
    if engine not in ("moments", "ml"):
        raise ValueError(f"unknown engine {engine!r}")
    if features is None:
        features = power_features(telemetry)
    if persist:
        features = features.persist(StorageLevel.MEMORY_AND_DISK)
    if split == "hash":
        train, test = hash_split(features, train_fraction, split_hash=split_hash)
    elif split == "random":
        train, test = random_split(features, (train_fraction, 1 - train_fraction), seed)
    else:
        raise ValueError(f"unknown split {split!r}")
    if exclude_day is not None:
        # Rows without a date are on no day and stay.
        train = train.filter(~F.col("signal_date").eqNullSafe(day_literal(exclude_day)))
    if engine == "moments":
        model = fit_least_squares(train)
    else:
        train = assemble(train)
        test = assemble(test)
        model = train_power_model(train)
    return PowerModelRun(model, features, train, test, score(model, test))
