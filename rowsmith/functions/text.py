"""Text expressions: bucketing, flags and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowsmith.fixed_values import TRUE_TEXTS, UNKNOWN

WHITE_SPACE = " \t\n\r\f\v"


def _hit(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?i){pattern}")


def bucket_last(text: Column, patterns: Mapping[str, str]) -> Column:
    """Bucket whose pattern is listed last among those that match; null without a match."""
    listed_last_first = reversed(patterns.items())
    return F.coalesce(*[F.when(_hit(text, p), F.lit(name)) for name, p in listed_last_first])


def bucket_first(
    text: Column, patterns: Mapping[str, str], default: str | None = UNKNOWN
) -> Column:
    """Bucket whose pattern is listed first among those that match, else ``default``."""
    found = [F.when(_hit(text, p), F.lit(name)) for name, p in patterns.items()]
    return F.coalesce(*found, F.lit(default))


def lower_trimmed(text: Column) -> Column:
    """Lower case without white space at either end."""
    return F.lower(F.trim(text, F.lit(WHITE_SPACE)))


def binary_flag(
    value: Column, true_texts: Sequence[str] = TRUE_TEXTS, trim: bool = False
) -> Column:
    """1 where the value reads as true, 0 otherwise and for null. Takes booleans and text."""
    text = value.cast("string")
    text = lower_trimmed(text) if trim else F.lower(text)
    return F.when(text.isin(*true_texts), 1).otherwise(0)


def binary_label(value: Column, negative: str) -> Column:
    """0 for the negative class, 1 for everything else including null."""
    return F.when(value == negative, 0).otherwise(1)
