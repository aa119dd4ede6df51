"""Counts: per value, per class, per split, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from rowsmith.operators.columns import quoted
from rowsmith.operators.identity import identified, salt
from rowsmith.operators.lookup import BROADCAST_BYTES, KeyTable, attach
from rowsmith.operators.ordering import row_numbers
from rowsmith.storage import materialize


def value_text(df: DataFrame, column: str) -> Column:
    """A value as text, equal for values that Spark groups together: both zeros, and every NaN."""
    value = quoted(column)
    if isinstance(df.schema[column].dataType, (FloatType, DoubleType)):
        value = value + F.lit(0.0).cast(df.schema[column].dataType)
    return value.cast("string")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) for every listed column, from one scan and one shuffle.

    Values are text; a null value is counted like any other.
    """
    texts = df.select(*[value_text(df, c).alias(c) for c in columns])
    long = texts.unpivot([], [quoted(c) for c in columns], "feature", "value")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class CategoryCounts:
    """Written value counts of several columns and their sizes.

    Index, frequency and one-hot encoders and the distinct counts all read this table,
    so the data are scanned once for the lot.
    """

    table: DataFrame
    sizes: dict[str, dict[str, int]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> CategoryCounts:
        table = materialize(value_counts(df, columns), "value_counts")
        measured = table.groupBy("feature").agg(
            *KeyTable.size_columns("value"),
            F.count_if(F.col("value").isNotNull()).alias("n_values"),
        )
        # One row per column of the table, however long the data are.
        sizes = {row["feature"]: row.asDict() for row in measured.collect()}
        empty = {"n_keys": 0, "n_bytes": 0, "total": 0, "n_values": 0}
        return cls(table, {c: sizes.get(c, empty) for c in columns})

    def of(self, column: str) -> DataFrame:
        """(key, n) of one column."""
        rows = self.table.filter(F.col("feature") == column)
        return rows.select(F.col("value").alias("key"), "n")

    def key_table(self, column: str, payload: str) -> KeyTable:
        """The counts of one column as a join table whose payload is the count."""
        size = self.sizes[column]
        rows = self.of(column).withColumn(payload, F.col("n"))
        return KeyTable(rows, (payload,), size["n_keys"], size["n_bytes"], size["total"])

    def single_valued(self) -> list[str]:
        """Columns with exactly one distinct non-null value."""
        return [c for c, size in self.sizes.items() if size["n_values"] == 1]


def group_count(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias(name))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count of each class and its percentage of all rows, by class."""
    counts = group_count(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total).orderBy(quoted(label))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """(feature, n_distinct) without nulls. The approximate form is one pass, no shuffle."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(quoted(c)).alias(c) for c in columns])
        return row.unpivot([], [quoted(c) for c in columns], "feature", "n_distinct")
    return (
        value_counts(df, columns)
        .groupBy("feature")
        .agg(F.count_if(F.col("value").isNotNull()).alias("n_distinct"))
    )


def drop_constant(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop those of ``columns`` that hold one distinct value. One aggregation, no shuffle of values."""
    if not columns:
        return df
    found = df.agg(*[F.min(quoted(c)).eqNullSafe(F.max(quoted(c))) & (F.count(quoted(c)) > 0) for c in columns]).first()
    return df.drop(*[c for c, is_constant in zip(columns, found) if is_constant])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


def sum_by_key(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    return df.groupBy(quoted(key)).agg(F.sum(quoted(value)).alias(name))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def group_lists(
    df: DataFrame,
    key: str,
    value: str,
    row_id: str,
    chunk_rows: int = 100_000,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Values of each key in order, cut into lists of ``chunk_rows``; the last list is shorter.

    One row per list: the key, ``chunk`` from 0, the number of ``chunks`` of the key, and
    ``values``. A value's place among those of its key decides its list, so no list is longer
    than ``chunk_rows``, however often a value or a row id repeats. Rows are numbered in sorted
    ranges, and no task holds a large group.
    """
    names = {"key": quoted(key), "value": quoted(value), "id": quoted(row_id)}
    # Equal rows are told apart by their identity, so that ranges can part them.
    rows, row = identified(df.select(*[c.alias(n) for n, c in names.items()]), "turn")
    turned = rows.withColumn(row, salt(row))
    numbered = row_numbers(turned, [F.col(c) for c in ("key", "value", "id", "turn")], "place")
    counted = numbered.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start"))
    table = KeyTable.measured(materialize(counted.withColumn("held", F.col("n")), "group_sizes"), ("start", "held"))
    located = attach(numbered, F.col("key"), table, True, broadcast_bytes)
    chunk = F.floor((F.col("place") - F.col("start")) / chunk_rows).cast("long")
    chunks = F.ceil(F.col("held") / F.lit(chunk_rows)).cast("long")
    return (
        located.groupBy(F.col("key").alias(key), chunks.alias("chunks"), chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list("value")).alias("values"))
    )


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """(label, n, weight) with weight = all rows / rows of the class."""
    counts = group_count(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn(name, total.cast("double") / F.col("n"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Each row with the weight of its class."""
    weights = class_weights(df, label, name).withColumnRenamed(label, "key")
    table = KeyTable.measured(materialize(weights, "class_weights"), (name,))
    return attach(df, quoted(label), table)


def split_class_counts(df: DataFrame, split: str, label: str) -> DataFrame:
    return df.groupBy(quoted(split), quoted(label)).agg(F.count(F.lit(1)).alias("n"))
