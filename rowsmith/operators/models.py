"""Forest and logistic models on assembled and scaled features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.fixed_values import BINARY_LOGISTIC_SETTINGS, FOREST_SETTINGS, LOGISTIC_SETTINGS
from rowsmith.operators.columns import present, quoted
from rowsmith.operators.features import assembler, scaler
from rowsmith.storage import materialize_in_tasks

RAW, SCALED = "features", "scaled_features"
# Deep trees are grown from a stored node per row and not from the root each time; the
# trees are the same.
FOREST_EXECUTION = {"cacheNodeIds": True}
# MLlib keeps the rows of a training task in memory: this many bytes a row, and eight a feature.
ROW_BYTES, FEATURE_BYTES = 350, 8
TASK_BYTES = 100_000_000


def forest(label: str, weight: str | None = None, **settings) -> RandomForestClassifier:
    return _with_weight(
        RandomForestClassifier(
            featuresCol=SCALED,
            labelCol=label,
            **{**FOREST_EXECUTION, **FOREST_SETTINGS, **settings},
        ),
        weight,
    )


def logistic(label: str, weight: str | None = None, **settings) -> LogisticRegression:
    """Multinomial when the label has more than two classes."""
    return _with_weight(
        LogisticRegression(featuresCol=SCALED, labelCol=label, **{**LOGISTIC_SETTINGS, **settings}),
        weight,
    )


def binary_logistic(label: str, **settings) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=SCALED, labelCol=label, **{**BINARY_LOGISTIC_SETTINGS, **settings}
    )


def _with_weight(estimator, weight: str | None):
    return estimator.setWeightCol(weight) if weight else estimator


def training_rows(
    train: DataFrame, features: Sequence[str], others: Sequence[str], task_bytes: int | None = None
) -> DataFrame:
    """Features and ``others`` of all rows to train on, so dealt that no task keeps over ``task_bytes``.

    A Parquet split of a few bytes a row becomes many times as much in memory, so rows are counted
    and not bytes. Rows that fit one task stay as they are; more are written to files of that many.
    """
    names = present(train, features)
    rows = max(1, (task_bytes or TASK_BYTES) // (ROW_BYTES + FEATURE_BYTES * len(names)))
    if train.count() <= rows:
        return train
    kept = train.select(*[quoted(c) for c in dict.fromkeys([*names, *others])])
    return materialize_in_tasks(kept, "training_rows", rows)


def fit_preparation(
    train: DataFrame, features: Sequence[str], handle_invalid: str = "skip", population: bool = False
) -> PipelineModel:
    """Assembler and scaler, fitted once and shared by the models trained on them.

    With ``population`` the spread is that of the rows themselves and not the sample estimate.
    """
    vectors = assembler(train, features, RAW, handle_invalid)
    if not population:
        return Pipeline(stages=[vectors, scaler(RAW, SCALED)]).fit(train)
    n = vectors.transform(train).count()
    size = len(vectors.getInputCols())
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    widened = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * size), inputCol="sample_scaled", outputCol=SCALED
    )
    return Pipeline(stages=[vectors, scaler(RAW, "sample_scaled"), widened]).fit(train)


def fit_model(
    train: DataFrame, features: Sequence[str], estimator: Estimator, handle_invalid: str = "skip"
) -> PipelineModel:
    """Assembler, scaler and model in one fitted pipeline."""
    weight = [estimator.getWeightCol()] if estimator.isSet("weightCol") else []
    train = training_rows(train, features, [estimator.getLabelCol(), *weight])
    stages = [assembler(train, features, RAW, handle_invalid), scaler(RAW, SCALED), estimator]
    return Pipeline(stages=stages).fit(train)


def scores(predictions: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns, the prediction and the class probabilities as an array."""
    return predictions.select(
        *[quoted(c) for c in keep],
        "prediction",
        vector_to_array(F.col("probability")).alias("probability"),
    )
