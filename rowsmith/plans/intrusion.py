"""Network intrusion: pre-made train and test files, one logistic model, ROC area."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith import fixed_values as fixed
from rowsmith.functions.text import binary_label
from rowsmith.operators import columns as cols
from rowsmith.operators import metrics, models
from rowsmith.operators.columns import quoted
from rowsmith.operators.filters import incomplete
from rowsmith.sources.delimited import read_headerless
from rowsmith.storage import materialize


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_headerless(spark, path, fixed.INTRUSION_COLUMNS)


def clean(records: DataFrame) -> DataFrame:
    """Numbers cast, label binarised, categories dropped; the same for train and test."""
    numeric = cols.cast_to_double(records, [*fixed.INTRUSION_TEXT, fixed.INTRUSION_LABEL])
    label = binary_label(quoted(fixed.INTRUSION_LABEL), fixed.INTRUSION_NORMAL)
    labelled = cols.derive(numeric, **{fixed.INTRUSION_LABEL: label})
    return cols.drop_columns(labelled, fixed.INTRUSION_TEXT)


def prepared(records: DataFrame) -> DataFrame:
    """The cleaned records, written once: what follows reads them several times."""
    return materialize(clean(records), "intrusion_records")


def feature_names(cleaned: DataFrame, with_difficulty: bool = False) -> list[str]:
    """Numeric columns. The difficulty score is known only with the outcome: off by default."""
    left_out = {fixed.INTRUSION_LABEL}
    if not with_difficulty:
        left_out.add(fixed.INTRUSION_DIFFICULTY)
    return [c for c in cleaned.columns if c not in left_out]


def fit(
    train: DataFrame, with_difficulty: bool = False, handle_invalid: str = "error"
) -> PipelineModel:
    """Scaler and model fitted on the cleaned train rows only."""
    estimator = models.binary_logistic(fixed.INTRUSION_LABEL)
    return models.fit_model(
        train, feature_names(train, with_difficulty), estimator, handle_invalid
    )


def score(model: PipelineModel, test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    predictions = model.transform(test)
    return models.scores(predictions, [fixed.INTRUSION_LABEL, *keep])


def run(
    train: DataFrame,
    test: DataFrame,
    with_difficulty: bool = False,
    handle_invalid: str = "error",
    report: bool = False,
) -> DataFrame:
    """(model, metric, value): the ROC area of the raw score on the test records.

    With ``report`` also the training time and how many test records were skipped.
    """
    return evaluate(prepared(train), prepared(test), with_difficulty, handle_invalid, report)


def evaluate(
    cleaned: DataFrame,
    records: DataFrame,
    with_difficulty: bool = False,
    handle_invalid: str = "error",
    report: bool = False,
) -> DataFrame:
    """``run`` from the prepared train and test records on."""
    started = time.monotonic()
    model = fit(cleaned, with_difficulty, handle_invalid)
    seconds = time.monotonic() - started
    predictions = metrics.positive_score(model.transform(records))
    area = metrics.metric_table(
        metrics.area_under_roc(predictions, fixed.INTRUSION_LABEL, "score"), "LogisticRegression"
    )
    if not report:
        return area
    missing = incomplete(records, feature_names(records, with_difficulty))
    skipped = F.count_if(missing) if handle_invalid == "skip" else F.count_if(F.lit(False))
    row = records.agg(
        skipped.cast("double").alias("skipped_test_rows"), F.max(F.lit(seconds)).alias("training_seconds")
    )
    return area.unionByName(metrics.metric_table(row, "LogisticRegression"))
