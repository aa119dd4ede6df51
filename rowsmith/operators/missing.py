"""Missing values: fills and profile."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.fixed_values import UNKNOWN
from rowsmith.functions.numbers import as_double
from rowsmith.operators.columns import present, quoted
from rowsmith.operators.quantiles import medians


def means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of each column, without nulls and NaN."""
    return df.agg(*[F.avg(as_double(quoted(c))).alias(c) for c in columns])


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls and NaN with the column mean; all means come from one aggregation.

    The columns become double, so that an integer column keeps a fractional mean.
    """
    statistics = means(df, columns).select(F.struct(*[quoted(c) for c in columns])).scalar()
    return df.withColumns(
        {c: F.coalesce(as_double(quoted(c)), statistics.getField(c)) for c in columns}
    )


@dataclass(frozen=True)
class NumericFill:
    """Fill values learned from one table and usable on another."""

    values: dict[str, float | None]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> NumericFill:
        """Learn the ``mean`` or the exact ``median`` of each column: one value per column."""
        if strategy == "mean":
            return cls(means(df, columns).first().asDict())
        if strategy == "median":
            return cls({r["feature"]: r["median"] for r in medians(df, columns).collect()})
        raise ValueError(f"unknown fill strategy {strategy!r}")

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: F.coalesce(as_double(quoted(c)), F.lit(value).cast("double"))
                for c, value in self.values.items()
            }
        )


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls and NaN with the exact column median."""
    return NumericFill.fit(df, columns, "median").transform(df)


def fill_text(df: DataFrame, columns: Iterable[str], value: str = UNKNOWN) -> DataFrame:
    """Fill nulls with a text; the columns become text, names the table lacks are ignored."""
    found = present(df, columns)
    return df.withColumns({c: F.coalesce(quoted(c).cast("string"), F.lit(value)) for c in found})


def replace_nan_text(df: DataFrame, columns: Sequence[str], value: str = UNKNOWN) -> DataFrame:
    """Turn columns into text in which ``nan`` and null read ``value``."""
    return df.withColumns({c: _without_nan(quoted(c).cast("string"), value) for c in columns})


def _without_nan(text: Column, value: str) -> Column:
    return F.when(text.isNull() | text.isin("nan", "NaN"), F.lit(value)).otherwise(text)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, missing_percent) of the columns that have nulls, from one pass."""
    columns = list(columns or df.columns)
    shares = df.agg(
        *[(F.count_if(quoted(c).isNull()) * 100.0 / F.count(F.lit(1))).alias(c) for c in columns]
    )
    long = shares.unpivot([], [quoted(c) for c in columns], "feature", "missing_percent")
    return long.filter(F.col("missing_percent") > 0)
