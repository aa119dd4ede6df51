"""Sorts, first rows, and row numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions.numbers import key_hash
from rowsmith.operators.columns import quoted
from rowsmith.storage import materialize

_PART, _ROW, _START = "__part", "__row", "__start"
# monotonically_increasing_id() keeps the row number within a partition in these bits.
ROW_BITS = 2**33 - 1


def order_by_label(df: DataFrame, label: str, row_id: str) -> DataFrame:
    """Sort by label. The row id splits a large class over many sort ranges."""
    return df.orderBy(quoted(label), quoted(row_id))


def shuffle_within_label(df: DataFrame, label: str, row_id: str, seed: int) -> DataFrame:
    """Sort by label and, inside it, in a random order that is the same on every run."""
    return df.orderBy(quoted(label), key_hash(quoted(row_id), seed))


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in an order; each task keeps no more than ``n``."""
    return df.orderBy(*order).limit(n)


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows from 0 in the given order.

    Ranges are sorted side by side and written with their local numbers; the start of
    each range is a running sum over one small row per range.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialize(
        ranges.withColumns(
            {
                _PART: F.spark_partition_id(),
                _ROW: F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)),
            }
        ),
        "row_numbers",
    )
    sizes = local.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_START))
    # One row per range, and the number of ranges is a setting of the session.
    numbered = local.join(F.broadcast(starts), _PART)
    return numbered.withColumn(name, F.col(_START) + F.col(_ROW)).drop(_PART, _ROW, _START)
