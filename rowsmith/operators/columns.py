"""Projections: drop, rename, select, derive, cast."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, TimestampNTZType, TimestampType

DATETIME_TYPES = (TimestampType, TimestampNTZType)
NUMERIC_TYPES = (NumericType,)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns; names the table lacks are ignored."""
    return df.drop(*names)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position, in one projection."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def select_except(df: DataFrame, names: Iterable[str]) -> DataFrame:
    left_out = set(names)
    return df.select(*[quoted(c) for c in df.columns if c not in left_out])


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that the table has, in the order given."""
    available = set(df.columns)
    return [n for n in names if n in available]


def derive(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or overwrite columns in one projection."""
    return df.withColumns(columns)


def cast_to_double(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Cast every column to double but those in ``keep``; unreadable text becomes null."""
    kept = set(keep)
    return df.select(
        *[quoted(c) if c in kept else quoted(c).try_cast("double").alias(c) for c in df.columns]
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: quoted(name).cast(kind) for name, kind in types.items()})


def columns_of_type(df: DataFrame, kinds: tuple[type[DataType], ...]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def drop_datetime(df: DataFrame) -> DataFrame:
    return select_except(df, columns_of_type(df, DATETIME_TYPES))


def keep_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in columns_of_type(df, NUMERIC_TYPES)])


def map_values(df: DataFrame, mapping: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Replace values found in ``mapping``; others and nulls pass through."""
    return df.replace(dict(mapping), subset=list(columns))


def quoted(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")
