"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.numbers import null_infinite
from rowsmith.operators.columns import quoted


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.filter(quoted(column) > threshold)


def divisible(df: DataFrame, column: str, divisor: int) -> DataFrame:
    return df.filter(quoted(column) % divisor == 0)


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose value is not in the list."""
    return df.filter(~quoted(column).isin(*values))


def replace_infinite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: null_infinite(quoted(c)) for c in columns})


def drop_incomplete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows without null or NaN in any feature."""
    return df.dropna(subset=list(features))


def incomplete(df: DataFrame, features: Sequence[str]) -> Column:
    """Is a feature of the row null or NaN?"""
    missing = F.lit(False)
    kinds = dict(df.dtypes)
    for name in features:
        missing = missing | quoted(name).isNull()
        if kinds[name] in ("double", "float"):
            missing = missing | F.isnan(quoted(name))
    return missing


def incomplete_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: how many rows there are, and how many ``drop_incomplete`` keeps and drops."""
    missing = incomplete(df, features)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~missing).alias("kept"),
        F.count_if(missing).alias("dropped"),
    )
