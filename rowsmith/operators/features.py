"""Feature vectors and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.numbers import as_double
from rowsmith.operators.columns import present, quoted


def assembler(
    df: DataFrame, features: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> VectorAssembler:
    """Assembler of the features that the table has; ``skip`` leaves out incomplete rows."""
    return VectorAssembler(
        inputCols=present(df, features), outputCol=output, handleInvalid=handle_invalid
    )


def assemble(
    df: DataFrame, features: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    return assembler(df, features, output, handle_invalid).transform(df)


def scaler(vector: str = "features", output: str = "scaled_features") -> StandardScaler:
    """Vector scaler to mean 0 and sample standard deviation 1."""
    return StandardScaler(inputCol=vector, outputCol=output, withMean=True, withStd=True)


def vector_values(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """The elements of a vector as one double column each."""
    values = df.withColumn("__values", vector_to_array(quoted(vector)))
    columns = {name: F.col("__values")[i] for i, name in enumerate(names)}
    return values.withColumns(columns).drop("__values", vector)


def sparse_entries(df: DataFrame, vector: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, position, value, width): a row per entry of a vector that is not zero.

    The stored places and values are read as they are; a sparse vector is never spread out to its
    width, so rows cost what they hold.
    """
    stored = F.unwrap_udt(quoted(vector))
    sparse = F.arrays_zip(stored["indices"].alias("position"), stored["values"].alias("value"))
    dense = F.transform(stored["values"], lambda x, i: F.struct(i.alias("position"), x.alias("value")))
    is_sparse = stored["type"] == 0
    entries = F.when(is_sparse, sparse).otherwise(dense)
    width = F.when(is_sparse, stored["size"]).otherwise(F.size(stored["values"])).cast("long")
    rows = df.select(*[quoted(c) for c in keep], width.alias("width"), F.inline(entries))
    return rows.filter("value <> 0").select(*[quoted(c) for c in keep], "position", "value", "width")


def _spread(x: Column, population: bool) -> Column:
    return F.stddev_pop(x) if population else F.stddev_samp(x)


def _scaled(x: Column, mean: Column, spread: Column) -> Column:
    return F.when(spread == 0, F.lit(0.0)).otherwise((x - mean) / spread)


@dataclass(frozen=True)
class ColumnScaler:
    """Means and standard deviations learned from one table and usable on another."""

    statistics: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], population: bool = False) -> ColumnScaler:
        """One aggregation for all columns; two numbers per column come back."""
        aggregates = []
        for i, c in enumerate(columns):
            x = as_double(quoted(c))
            aggregates += [F.avg(x).alias(f"m{i}"), _spread(x, population).alias(f"s{i}")]
        row = df.agg(*aggregates).first()
        return cls({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: _scaled(as_double(quoted(c)), F.lit(mean), F.lit(spread))
                for c, (mean, spread) in self.statistics.items()
            }
        )


def scale_columns(df: DataFrame, columns: Sequence[str], population: bool = False) -> DataFrame:
    """Scale columns by their own statistics, in one query."""
    pairs = [
        F.struct(
            F.avg(as_double(quoted(c))).alias("mean"),
            _spread(as_double(quoted(c)), population).alias("spread"),
        ).alias(c)
        for c in columns
    ]
    statistics = df.agg(F.struct(*pairs).alias("statistics")).scalar()
    return df.withColumns(
        {
            c: _scaled(
                as_double(quoted(c)),
                statistics.getField(c).getField("mean"),
                statistics.getField(c).getField("spread"),
            )
            for c in columns
        }
    )
