"""Timestamp parsing and the features derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowsmith.fixed_values import TIMESTAMP_FORMAT, TIMESTAMP_LENGTH, UNKNOWN


def timestamp_text(value: Column) -> Column:
    """The first 19 characters, which leaves out any fraction of a second."""
    return F.substring(value, 1, TIMESTAMP_LENGTH)


def parse_timestamp(value: Column, layout: str = TIMESTAMP_FORMAT) -> Column:
    """Timestamp of a text; null where it does not follow the layout."""
    return F.try_to_timestamp(timestamp_text(value), F.lit(layout))


def hour_of(moment: Column, base: int = 0) -> Column:
    """Hour 0 to 23, or 1 to 24 with base 1."""
    return F.hour(moment) + base if base else F.hour(moment)


def day_of_week(moment: Column, monday_first: bool = False) -> Column:
    """1 to 7, from Sunday unless ``monday_first``."""
    return F.weekday(moment) + 1 if monday_first else F.dayofweek(moment)


def month(moment: Column) -> Column:
    return F.month(moment)


def year(moment: Column) -> Column:
    return F.year(moment)


def part_of_day(hour: Column) -> Column:
    """Night 1-6, Morning 7-12, Afternoon 13-18, Evening for the rest and for null."""
    return (
        F.when(hour.between(1, 6), "Night")
        .when(hour.between(7, 12), "Morning")
        .when(hour.between(13, 18), "Afternoon")
        .otherwise("Evening")
    )


def part_of_day_bins(hour: Column) -> Column:
    """Bins closed on the right, the first also on the left; Unknown outside and for null."""
    return (
        F.when(hour.between(0, 6), "Night")
        .when((hour > 6) & (hour <= 12), "Morning")
        .when((hour > 12) & (hour <= 18), "Afternoon")
        .when((hour > 18) & (hour <= 24), "Evening")
        .otherwise(UNKNOWN)
    )


def day_flag(hour: Column, first_day_hour: int | None = 1) -> Column:
    """Day from ``first_day_hour`` to 16, else Night; no lower bound with None."""
    is_day = hour <= 16 if first_day_hour is None else hour.between(first_day_hour, 16)
    return F.when(is_day, "Day").otherwise("Night")
