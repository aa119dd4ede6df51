"""Numeric expressions: missing values and repeatable pseudo-random numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 8
HASH_RANGE = 16**HASH_DIGITS


def as_double(value: Column) -> Column:
    """Double, with NaN turned into null so that it cannot spread through an average."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def null_infinite(value: Column) -> Column:
    """Null in place of either infinity."""
    return F.when(~value.isin(float("inf"), float("-inf")), value)


def key_hash(key: Column, seed: int | str | None = None) -> Column:
    """Hex digest of a key. Unlike rand() it gives the same value when a task runs again."""
    text = key.cast("string")
    return F.md5(text if seed is None else F.concat(F.lit(f"{seed}:"), text))


def hash_integer(key: Column, bound: int, seed: int | str | None = None) -> Column:
    """Whole number in [0, bound) drawn from the key."""
    digits = F.substring(key_hash(key, seed), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("long") % bound


def hash_uniform(key: Column, seed: int | str | None = None) -> Column:
    """Number in [0, 1) drawn from the key."""
    return hash_integer(key, HASH_RANGE, seed) / F.lit(float(HASH_RANGE))
