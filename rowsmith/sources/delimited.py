"""Delimited files with or without a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rowsmith.operators.columns import rename_all


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Scan files with a header line.

    A schema saves the extra pass that type inference costs, and its names are checked
    against the header. Text that does not fit its type becomes null.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_headerless(
    spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str = ","
) -> DataFrame:
    """Scan files without a header: text columns that take ``names`` by position."""
    return rename_all(spark.read.csv(path, header=False, sep=sep), names)


def write_delimited(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    df.write.csv(path, header=header, sep=sep)
