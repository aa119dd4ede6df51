"""Rows that come from the program and not from a file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowsmith.fixed_values import (
    READING_DAYS,
    READING_FIRST_DAY,
    READING_FIRST_UID,
    READING_HIGH,
    READING_LOW,
    READING_TIDS,
)
from rowsmith.functions.numbers import hash_integer, hash_uniform


def literal_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A small table written out in the program."""
    return spark.createDataFrame(list(rows), schema)


def number_range(spark: SparkSession, start: int, stop: int, name: str = "x") -> DataFrame:
    """Whole numbers in [start, stop), generated on the executors."""
    return spark.range(start, stop).withColumnRenamed("id", name)


def random_date(key, first_day: str = READING_FIRST_DAY, days: int = READING_DAYS, seed="date"):
    """Date at most ``days - 1`` days after ``first_day``, drawn from the key."""
    return F.date_add(F.lit(first_day).cast("date"), hash_integer(key, days, seed).cast("int"))


def readings_for(rows: DataFrame, position: str) -> DataFrame:
    """One synthetic reading (TID, UID, val, time) per row; ``position`` counts from 0."""
    key = F.col(position)
    spread = READING_HIGH - READING_LOW
    return rows.select(
        (hash_integer(key, READING_TIDS, "tid") + 1).cast("int").alias("TID"),
        (key + READING_FIRST_UID).cast("long").alias("UID"),
        F.round(hash_uniform(key, "val") * spread + READING_LOW, 2).alias("val"),
        random_date(key).alias("time"),
    )


def readings(spark: SparkSession, n: int) -> DataFrame:
    """``n`` synthetic readings, the same on every run."""
    return readings_for(number_range(spark, 0, n), "x")
