"""Models of several kinds, fitted, stored, loaded and scored alike.

A kind says how bars become feature vectors, how a model is fitted on labelled
rows, how it is stored and read, and how rows are scored. Jobs and the live loop
know kinds by name only (:data:`KINDS`), so a loop may run models of different
kinds side by side. A stored model is a folder with the table ``kind`` (one
row, the name) beside the model's own tables.

* ``knn`` -- lags imputed and divided by the base; nearest neighbours.
* ``linear`` -- lags filled along the row and divided by the base; least squares, one model per instrument.
* ``stacked`` -- the same lags; least squares per lookback under a final one, one model per instrument.

Labelled rows are ``epic, updated_at, seq, split, y_true, level, vec``; rows to
score have the key, ``level`` and ``vec``. Scores come as key and ``y_pred``.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.operators import features, forecast, knn

ROW_KEY = ["epic", "updated_at", "seq"]
FOLDS = 5


def training_matrix(bars: DataFrame, past_periods: int) -> DataFrame:
    """M3 front half + W14: target, past asks, impute, normalise, chronological
    split -> one row per labelled bar with its feature vector."""
    rows = (features.shift_features(bars, future={"bid_open": 1}, past={"ask_open": past_periods})
            .transform(features.return_target, alias="y_true").filter(F.col("y_true").isNotNull())
            .withColumn("level", F.col("ask_open")))
    cols = features.lag_columns("ask_open", past_periods)
    rows = features.normalise(features.impute(rows, cols), cols)
    return features.chronological_split(rows).select(*ROW_KEY, "split", "y_true", "level",
                                            F.array(*[F.col(c) for c in cols]).alias("vec"))


def imputed_vectors(bars: DataFrame, past_periods: int) -> DataFrame:
    """Bars with ``level`` and the vector of :func:`training_matrix`, label or not."""
    rows = features.model_features(bars.withColumn("level", F.col("ask_open")), past_periods)
    return rows.withColumn("vec", F.array(*[F.col(c) for c in features.lag_columns("ask_open", past_periods)]))


def ratio_matrix(bars: DataFrame, deepest: int) -> DataFrame:
    """The linear kinds' labelled rows: lags filled along the row over the base, split as above."""
    rows = forecast.stacked_features(bars, deepest, ["epic"], list(features.ORDER), future={"bid_open": 1})
    rows = features.return_target(rows, alias="y_true").filter(F.col("y_true").isNotNull())
    return features.chronological_split(rows).select(*ROW_KEY, "split", "y_true", F.col("ask_open").alias("level"),
                                                     F.col("x").alias("vec"))


def ratio_vectors(bars: DataFrame, deepest: int) -> DataFrame:
    """Bars with ``level`` and the vector of :func:`ratio_matrix`, label or not."""
    rows = forecast.stacked_features(bars, deepest, ["epic"], list(features.ORDER))
    return rows.withColumn("level", F.col("ask_open")).withColumnRenamed("x", "vec")


def _fit_linear(train: DataFrame, lookbacks: Sequence[int], **_) -> DataFrame:
    rows = train.withColumnRenamed("vec", "x").withColumn("fold", F.lit(0))  # no fold is left out
    base = F.get("bases", F.lit(0))
    return forecast.stacked_fit(rows, [max(lookbacks)], "y_true", ["epic"]).select(
        "epic", "n", F.slice(base, F.lit(1), F.size(base) - 1).alias("coef"), F.element_at(base, -1).alias("intercept"))


def _fit_stacked(train: DataFrame, lookbacks: Sequence[int], **_) -> DataFrame:
    rows = forecast.contiguous_folds(train.withColumnRenamed("vec", "x"), FOLDS, ["epic"], list(features.ORDER))
    return forecast.stacked_fit(rows, list(lookbacks), "y_true", ["epic"])


def _predict_form(rows: DataFrame, model: DataFrame, **_) -> DataFrame:
    """A linear form per instrument; an instrument without a model has no score."""
    scored = forecast.stacked_predict(rows.withColumnRenamed("vec", "x"), model, ["epic"], alias="y_pred")
    return scored.filter(F.col("y_pred").isNotNull()).select(*ROW_KEY, "y_pred")


def _save_table(model: DataFrame, path: str) -> DataFrame:
    model.write.mode("overwrite").parquet(f"{path}/form")
    return model.sparkSession.read.parquet(f"{path}/form")


def _pin_table(model: DataFrame) -> tuple[DataFrame, Callable[[], object]]:
    held = model.persist()
    return held, held.unpersist


def _pin_knn(model: knn.KnnModel) -> tuple[knn.KnnModel, Callable[[], object]]:
    cells = model.cells.persist()
    return dataclasses.replace(model, cells=cells), cells.unpersist


@dataclasses.dataclass(frozen=True)
class Kind:
    """``matrix(bars, depth)`` and ``vectors(bars, depth)`` give labelled rows and rows to score,
    ``fit(train, **params)`` a model, ``predict(rows, model, **params)`` its scores; ``pin`` keeps
    a model for many searches and returns what releases it."""
    label: str
    matrix: Callable[[DataFrame, int], DataFrame]
    vectors: Callable[[DataFrame, int], DataFrame]
    fit: Callable
    predict: Callable
    save: Callable
    load: Callable
    pin: Callable


KINDS: Mapping[str, Kind] = {
    "knn": Kind("knn-reg-model", training_matrix, imputed_vectors,
                lambda train, **_: knn.fit(train, ROW_KEY, y="y_true"),
                lambda rows, model, k, **_: knn.knn_predict(knn.search(rows, model, k, ROW_KEY), ROW_KEY),
                knn.save, knn.load, _pin_knn),
    "linear": Kind("linear-reg-model", ratio_matrix, ratio_vectors, _fit_linear, _predict_form, _save_table,
                   lambda spark, path: spark.read.parquet(f"{path}/form"), _pin_table),
    "stacked": Kind("stacked-linear-reg-model", ratio_matrix, ratio_vectors, _fit_stacked, _predict_form, _save_table,
                    lambda spark, path: spark.read.parquet(f"{path}/form"), _pin_table),
}


def save(spark: SparkSession, kind: str, model, path: str):
    """Store a fitted model with its kind; returns it as read back."""
    stored = KINDS[kind].save(model, path)
    spark.createDataFrame([(kind,)], "kind string").coalesce(1).write.mode("overwrite").parquet(f"{path}/kind")
    return stored


def load(spark: SparkSession, path: str) -> tuple[str, object]:
    """``(kind, model)`` of a stored model."""
    kind = spark.read.parquet(f"{path}/kind").first()["kind"]
    if kind not in KINDS:
        raise ValueError(f"{path} holds a model of the unknown kind {kind}")
    return kind, KINDS[kind].load(spark, path)
