"""Category encoders: index, frequency, one-hot, binary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from rowsmith.fixed_values import TRUE_TEXTS
from rowsmith.functions.text import binary_flag
from rowsmith.operators.columns import columns_of_type, present, quoted
from rowsmith.operators.counts import CategoryCounts, value_text
from rowsmith.operators.lookup import BROADCAST_BYTES, KeyTable, Lookup, attach_all
from rowsmith.operators.ordering import row_numbers

# Up to this many labels are ranked in one task; more are ranked by sorted ranges.
RANKED_LABELS = 100_000


@dataclass(frozen=True)
class FrequencyEncoder:
    """Replace a category by how often it occurs in the table it was fitted on."""

    counts: CategoryCounts
    columns: tuple[str, ...]
    null_policy: str = "drop"
    unseen_as_zero: bool = False
    broadcast_bytes: int = BROADCAST_BYTES

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        columns: Sequence[str],
        null_policy: str = "drop",
        counts: CategoryCounts | None = None,
        unseen_as_zero: bool = False,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> FrequencyEncoder:
        """``null_policy``: ``drop`` leaves a null key without a frequency, ``count`` counts it.

        A value that the fitted table lacks gets null, or 0 with ``unseen_as_zero``.
        """
        if null_policy not in ("drop", "count"):
            raise ValueError(f"unknown null policy {null_policy!r}")
        counts = counts or CategoryCounts.fit(df, columns)
        return cls(counts, tuple(columns), null_policy, unseen_as_zero, broadcast_bytes)

    def transform(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        """Add ``<column>_freq`` and drop the column."""
        return encode_all(df, [self], keep_source, self.broadcast_bytes)

    def lookups(self, df: DataFrame) -> list[Lookup]:
        by_null = self.null_policy == "count"
        return [Lookup(value_text(df, c), self.counts.key_table(c, f"{c}_freq"), by_null) for c in self.columns]

    def finished(self, df: DataFrame) -> DataFrame:
        """``df``, with the values looked up, as the encoder leaves it."""
        if not self.unseen_as_zero:
            return df
        is_key = {c: F.lit(True) if self.null_policy == "count" else quoted(c).isNotNull() for c in self.columns}
        return df.withColumns(
            {f"{c}_freq": F.coalesce(quoted(f"{c}_freq"), F.when(is_key[c], F.lit(0))) for c in self.columns}
        )


@dataclass(frozen=True)
class LabelIndexer:
    """Number labels by descending count (ties by label) or alphabetically, from 0."""

    tables: dict[str, KeyTable]
    n_labels: dict[str, int]
    handle_invalid: str = "keep"
    broadcast_bytes: int = BROADCAST_BYTES

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        columns: Sequence[str],
        order: str = "frequency",
        handle_invalid: str = "keep",
        counts: CategoryCounts | None = None,
        ranked_labels: int = RANKED_LABELS,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> LabelIndexer:
        """``handle_invalid``: null and unseen labels get one extra number (``keep``),
        stay null (``null``), or lose their row (``skip``)."""
        if order not in ("frequency", "alphabet"):
            raise ValueError(f"unknown label order {order!r}")
        if handle_invalid not in ("keep", "null", "skip"):
            raise ValueError(f"unknown treatment of invalid labels {handle_invalid!r}")
        counts = counts or CategoryCounts.fit(df, columns)
        tables, n_labels = {}, {}
        for c in columns:
            size = counts.sizes[c]
            index = f"{c}_idx"
            numbered = _number_labels(counts, c, order, ranked_labels, index)
            tables[c] = KeyTable(
                numbered, (index,), size["n_keys"], size["n_bytes"], size["total"]
            )
            n_labels[c] = size["n_values"]
        return cls(tables, n_labels, handle_invalid, broadcast_bytes)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.tables)

    def transform(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        """Add ``<column>_idx`` as double and drop the column."""
        return encode_all(df, [self], keep_source, self.broadcast_bytes)

    def lookups(self, df: DataFrame) -> list[Lookup]:
        return [Lookup(value_text(df, c), table) for c, table in self.tables.items()]

    def finished(self, df: DataFrame) -> DataFrame:
        """``df``, with the values looked up, as the encoder leaves it."""
        index = {c: quoted(f"{c}_idx") for c in self.tables}
        if self.handle_invalid == "keep":
            return df.withColumns({f"{c}_idx": F.coalesce(x, F.lit(float(self.n_labels[c]))) for c, x in index.items()})
        if self.handle_invalid == "skip":
            return df.dropna(subset=[f"{c}_idx" for c in index])
        return df


def encode_all(
    df: DataFrame,
    encoders: Sequence[FrequencyEncoder | LabelIndexer],
    keep_source: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    row: str | None = None,
) -> DataFrame:
    """Apply encoders that read the columns of ``df``, with one set of joins for all of them.

    Tables that together stay within ``broadcast_bytes`` are broadcast; all others are joined at
    once. ``row`` names a column with the identity of the rows, if there is one.
    """
    found = attach_all(df, [x for e in encoders for x in e.lookups(df)], broadcast_bytes, row)
    for encoder in encoders:
        found = encoder.finished(found)
    return found if keep_source else found.drop(*[c for e in encoders for c in e.columns])


def _number_labels(
    counts: CategoryCounts, column: str, order: str, ranked_labels: int, index: str
) -> DataFrame:
    labels = counts.of(column).filter("key is not null")
    keys = [F.col("n").desc(), F.col("key")] if order == "frequency" else [F.col("key")]
    if counts.sizes[column]["n_values"] <= ranked_labels:
        position = F.row_number().over(Window.orderBy(*keys)) - 1
        numbered = labels.withColumn(index, position)
    else:
        numbered = row_numbers(labels, keys, index)
    return numbered.withColumn(index, quoted(index).cast("double"))


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    counts: CategoryCounts | None = None,
    categories: dict[str, Sequence[str]] | None = None,
    keep_source: bool = False,
) -> DataFrame:
    """One 0/1 column ``<column>_<category>`` per category; a null category is all zeros.

    Categories are those given, else those counted; there is no limit. The columns of a table
    are part of its plan, so where the number of categories is open ``one_hot_vectors`` is the
    form that grows with the data.
    """
    if categories is None:
        categories = _counted_categories(counts or CategoryCounts.fit(df, columns), columns)
    added = {
        f"{c}_{value}": F.when(value_text(df, c) == value, 1).otherwise(0)
        for c in columns
        for value in categories[c]
    }
    encoded = df.withColumns(added)
    return encoded if keep_source else encoded.drop(*columns)


def _counted_categories(counts: CategoryCounts, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories of each column; they become columns, so they fit the plan and the driver."""
    return {
        c: [r["key"] for r in counts.of(c).filter("key is not null").orderBy("key").select("key").collect()]
        for c in columns
    }


def one_hot_vectors(df: DataFrame, index_columns: Sequence[str], drop_last: bool = False):
    """Indexed columns as sparse 0/1 vectors ``<column>_vec``."""
    encoder = OneHotEncoder(
        inputCols=list(index_columns),
        outputCols=[f"{c}_vec" for c in index_columns],
        dropLast=drop_last,
        handleInvalid="keep",
    )
    return encoder.fit(df).transform(df)


def binary_flags(
    df: DataFrame,
    columns: Sequence[str],
    true_texts: Sequence[str] = TRUE_TEXTS,
    trim: bool = False,
    keep_source: bool = False,
) -> DataFrame:
    """Add ``<column>_bin`` for the columns the table has, and drop those columns."""
    found = present(df, columns)
    boolean = set(columns_of_type(df, (BooleanType,))) if "true" in true_texts else set()
    flags = {
        f"{c}_bin": F.when(quoted(c), 1).otherwise(0)
        if c in boolean
        else binary_flag(quoted(c), true_texts, trim)
        for c in found
    }
    flagged = df.withColumns(flags)
    return flagged if keep_source else flagged.drop(*found)
