"""Accident severity: clean, encode, split, train two models, evaluate."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith import fixed_values as fixed
from rowsmith.functions import dates
from rowsmith.functions.text import bucket_first, bucket_last
from rowsmith.operators import columns as cols
from rowsmith.operators import encode, metrics, models, split
from rowsmith.operators.columns import quoted
from rowsmith.operators.counts import CategoryCounts, with_class_weight
from rowsmith.operators.filters import incomplete
from rowsmith.operators.identity import identified
from rowsmith.operators.missing import NumericFill, fill_text
from rowsmith.storage import materialize


@dataclass(frozen=True)
class SeverityOptions:
    """The points in which variants of the job differ."""

    hour_base: int = 0
    monday_first: bool = False
    binned_day: bool = False
    weather_match: str = "last"
    numeric_fill: str = "mean"
    index_order: str = "frequency"
    text_filled: tuple[str, ...] = tuple(fixed.ACCIDENT_TEXT)
    null_policy: str = "drop"
    trim_flags: bool = False
    small_categories: str = "drop"
    all_features: bool = False
    fit_on: str = "all"
    split: str = "stratified"
    class_weights: bool = False
    scaling: str = "sample"
    forest: tuple[tuple[str, object], ...] = ()
    logistic: tuple[tuple[str, object], ...] = ()


    def __post_init__(self) -> None:
        allowed = {
            "weather_match": ("last", "first"),
            "numeric_fill": ("mean", "median"),
            "small_categories": ("drop", "one_hot", "index"),
            "fit_on": ("all", "train"),
            "split": ("stratified", "random"),
            "scaling": ("sample", "population"),
            "null_policy": ("drop", "count"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")


DEFAULTS = SeverityOptions()
VARIANTS = {
    "cluster": DEFAULTS,
    "notebook": SeverityOptions(hour_base=1, text_filled=tuple(fixed.ACCIDENT_TEXT_SHORT)),
    "single_machine": SeverityOptions(
        monday_first=True,
        binned_day=True,
        weather_match="first",
        numeric_fill="median",
        index_order="alphabet",
        text_filled=tuple(fixed.ACCIDENT_TEXT_SHORT),
        trim_flags=True,
        small_categories="one_hot",
        all_features=True,
        scaling="population",
    ),
    "single_machine_short": SeverityOptions(
        hour_base=1,
        monday_first=True,
        weather_match="first",
        index_order="alphabet",
        text_filled=tuple(fixed.ACCIDENT_TEXT_SHORT),
        small_categories="index",
        all_features=True,
        scaling="population",
    ),
}
SPLIT = "split"


def clean(accidents: DataFrame, options: SeverityOptions = DEFAULTS) -> DataFrame:
    """Everything that needs one row only. Keeps ID, which decides the split."""
    unused = [c for c in fixed.ACCIDENT_UNUSED if c != "ID"]
    kept = cols.drop_columns(accidents, unused)
    mapped = cols.map_values(kept, fixed.COMPASS_POINTS, ["Wind_Direction"])
    weather = quoted("Weather_Condition")
    bucket = bucket_last if options.weather_match == "last" else bucket_first
    started = cols.derive(
        mapped,
        Weather_Condition=bucket(weather, fixed.WEATHER_PATTERNS),
        Start_Time=dates.parse_timestamp(quoted("Start_Time")),
    )
    moment = quoted("Start_Time")
    hour = quoted("Hour")
    dated = cols.derive(
        started,
        Hour=dates.hour_of(moment, options.hour_base),
        Day=dates.day_of_week(moment, options.monday_first),
        Month=dates.month(moment),
        Year=dates.year(moment),
    )
    if options.binned_day:
        part, flag = dates.part_of_day_bins(hour), dates.day_flag(hour, None)
    else:
        part, flag = dates.part_of_day(hour), dates.day_flag(hour)
    parted = cols.derive(dated, Part_of_Day=part, Sunrise_Sunset=flag).drop("Start_Time")
    filled = fill_text(parted, options.text_filled)
    flagged = encode.binary_flags(filled, fixed.ACCIDENT_FLAGS, trim=options.trim_flags)
    if options.small_categories == "drop":
        return flagged.drop(*fixed.ACCIDENT_ONE_HOT)
    if options.small_categories == "index":
        return fill_text(flagged, fixed.ACCIDENT_ONE_HOT)
    return flagged


def features(accidents: DataFrame, options: SeverityOptions = DEFAULTS) -> DataFrame:
    """Encoded and selected features with the label and the ``split`` mark, written once.

    The input is read once: its cleaned rows are written and all statistics come from
    that narrower table.
    """
    # Rows keep the identity they have in the written table through split, fills and encoders.
    cleaned, row = identified(materialize(clean(accidents, options), "accidents_clean"))
    if options.split == "stratified":
        marked = split.stratified_split(cleaned, fixed.ACCIDENT_LABEL, "ID", name=SPLIT)
    else:
        marked = split.random_split(cleaned, "ID", name=SPLIT)
    known = cleaned if options.fit_on == "all" else marked.filter(quoted(SPLIT) == split.TRAIN)

    fill = NumericFill.fit(known, fixed.ACCIDENT_NUMERIC, options.numeric_fill)
    small = fixed.ACCIDENT_ONE_HOT if options.small_categories != "drop" else []
    indexed = fixed.ACCIDENT_INDEXED + (small if options.small_categories == "index" else [])
    # Columns that selection drops are not encoded first.
    unused = set(fixed.ACCIDENT_LOW_CORRELATION)
    indexed = [c for c in indexed if f"{c}_idx" not in unused]
    by_frequency = [c for c in fixed.ACCIDENT_FREQUENCY if f"{c}_freq" not in unused]
    counts = CategoryCounts.fit(known, list(dict.fromkeys(indexed + by_frequency + small)))
    indexer = encode.LabelIndexer.fit(known, indexed, options.index_order, counts=counts)
    frequency = encode.FrequencyEncoder.fit(
        known,
        by_frequency,
        options.null_policy,
        counts=counts,
        unseen_as_zero=options.fit_on == "train",
    )
    encoded = encode.encode_all(fill.transform(marked), [indexer, frequency], row=row)
    left = {*fixed.ACCIDENT_INDEXED, *fixed.ACCIDENT_FREQUENCY} - {*indexed, *by_frequency}
    encoded = cols.drop_columns(encoded, sorted(left))
    if options.small_categories == "one_hot":
        encoded = encode.one_hot(encoded, fixed.ACCIDENT_ONE_HOT, counts)
    selected = cols.drop_columns(encoded, fixed.ACCIDENT_LOW_CORRELATION)
    return materialize(selected.drop("ID", row), "accident_features")


def feature_names(table: DataFrame, options: SeverityOptions = DEFAULTS) -> list[str]:
    """The listed features, or every column but the label and the split mark."""
    if options.all_features:
        return [c for c in table.columns if c not in (fixed.ACCIDENT_LABEL, SPLIT)]
    return cols.present(table, fixed.ACCIDENT_FEATURES)


def train_models(
    table: DataFrame, options: SeverityOptions = DEFAULTS, seconds: dict[str, float] | None = None
) -> tuple[PipelineModel, dict, DataFrame]:
    """Fitted preparation, fitted models by name, and the prepared test rows.

    ``seconds`` is filled with the training time of each model.
    """
    train, test = split.parts(table, SPLIT)
    names = feature_names(table, options)
    weight = None
    if options.class_weights:
        weight = "class_weight"
        train = with_class_weight(train, fixed.ACCIDENT_LABEL, weight)
    train = models.training_rows(train, names, [fixed.ACCIDENT_LABEL, *([weight] if weight else [])])
    preparation = models.fit_preparation(train, names, population=options.scaling == "population")
    ready = preparation.transform(train)
    estimators = {
        "RandomForest": models.forest(fixed.ACCIDENT_LABEL, weight, **dict(options.forest)),
        "LogisticRegression": models.logistic(
            fixed.ACCIDENT_LABEL, weight, **dict(options.logistic)
        ),
    }
    fitted = {}
    for name, estimator in estimators.items():
        started = time.monotonic()
        fitted[name] = estimator.fit(ready)
        if seconds is not None:
            seconds[name] = time.monotonic() - started
    return preparation, fitted, preparation.transform(test)


def run(
    accidents: DataFrame, options: SeverityOptions = DEFAULTS, report: bool = False
) -> DataFrame:
    """(model, metric, value) of both models on the test rows.

    With ``report`` also the seconds each model took to train and how many train and test rows
    were skipped because a feature was missing.
    """
    return evaluate(features(accidents, options), options, report)


def evaluate(table: DataFrame, options: SeverityOptions = DEFAULTS, report: bool = False) -> DataFrame:
    """``run`` from the written features on."""
    seconds: dict[str, float] = {}
    _, fitted, test = train_models(table, options, seconds)
    tables = [
        metrics.metric_table(
            metrics.classification_metrics(model.transform(test), fixed.ACCIDENT_LABEL), name
        )
        for name, model in fitted.items()
    ]
    if report:
        tables.append(_report(table, options, seconds))
    return reduce(DataFrame.unionByName, tables)


def _report(table: DataFrame, options: SeverityOptions, seconds: dict[str, float]) -> DataFrame:
    missing = incomplete(table, feature_names(table, options))
    side = {part: quoted(SPLIT) == part for part in (split.TRAIN, split.TEST)}
    skipped = table.agg(
        *[F.count_if(missing & rows).cast("double").alias(f"skipped_{part}_rows") for part, rows in side.items()]
    )
    times = table.sparkSession.createDataFrame(
        [(model, "training_seconds", took) for model, took in seconds.items()],
        "model string, metric string, value double",
    )
    return times.unionByName(metrics.metric_table(skipped, "all"))
