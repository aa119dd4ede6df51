"""Synthetic readings: high values and the sum per TID."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowsmith.operators.counts import sum_by_key
from rowsmith.operators.filters import above

HIGH_VALUE = 100


def high_readings(rows: DataFrame) -> DataFrame:
    return above(rows, "val", HIGH_VALUE)


def totals(rows: DataFrame) -> DataFrame:
    return sum_by_key(rows, "TID", "val")
