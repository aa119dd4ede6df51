"""Correlation of features with the label, and selection by it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.fixed_values import IRRELEVANT_BOUND, NOISE_BOUND
from rowsmith.functions.numbers import as_double
from rowsmith.operators.columns import NUMERIC_TYPES, columns_of_type, quoted


def label_correlation(
    df: DataFrame,
    label: str,
    features: Sequence[str] | None = None,
    null_as_zero: bool = False,
) -> DataFrame:
    """(feature, correlation) with the label, all features in one aggregation.

    Each pair uses the rows in which both values are present, or with ``null_as_zero``
    every row. A constant feature has no correlation: null. The label itself, in any
    case of its letters, is not a feature.
    """
    if features is None:
        features = columns_of_type(df, NUMERIC_TYPES)
    features = [c for c in features if c.lower() != label.lower()]
    target = _present(quoted(label), null_as_zero)
    row = df.agg(
        *[pearson(_present(quoted(c), null_as_zero), target).alias(c) for c in features]
    )
    return row.unpivot([], [quoted(c) for c in features], "feature", "correlation")


def pearson(x: Column, y: Column) -> Column:
    """Aggregate over pairwise complete rows; null instead of an error for constants."""
    paired_x, paired_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_samp(paired_x) * F.stddev_samp(paired_y)
    return F.try_divide(F.covar_samp(x, y), spread)


def _present(value: Column, null_as_zero: bool) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0)) if null_as_zero else as_double(value)


def rank_features(correlations: DataFrame, by_absolute: bool = False) -> DataFrame:
    """Correlations from high to low, without features that have none."""
    ranked = correlations.filter("correlation is not null")
    if by_absolute:
        ranked = ranked.withColumn("abs_correlation", F.abs("correlation"))
    order = "abs_correlation" if by_absolute else "correlation"
    return ranked.orderBy(F.col(order).desc(), "feature")


def relevance(
    correlations: DataFrame,
    noise: float = NOISE_BOUND,
    irrelevant: float = IRRELEVANT_BOUND,
) -> DataFrame:
    """Name each feature ``noise``, ``irrelevant`` or ``relevant`` by its correlation."""
    size = F.abs("correlation")
    kind = (
        F.when(size < noise, "noise").when(size < irrelevant, "irrelevant").otherwise("relevant")
    )
    return correlations.filter("correlation is not null").withColumn("relevance", kind)


def drop_uncorrelated(
    df: DataFrame, label: str, features: Sequence[str], bound: float = NOISE_BOUND
) -> DataFrame:
    """Drop the features whose absolute correlation with the label is below ``bound``."""
    weak = label_correlation(df, label, features).filter(F.abs("correlation") < bound)
    # At most one row per feature asked for.
    return df.drop(*[row["feature"] for row in weak.collect()])
