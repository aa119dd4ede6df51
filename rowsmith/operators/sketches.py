"""Stored sketches per part of the data, merged when they are read.

A part, a day say, is summarised once: per column the number of values, a sketch of its distinct
values and, for numbers, a sketch of its ranks. The summary of all parts is a merge of these few
rows. A new part adds its own rows and reads no other; a part that is summarised again replaces
what it had, so a job that runs twice counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from rowsmith.functions.numbers import as_double
from rowsmith.operators.columns import quoted
from rowsmith.operators.counts import value_text

#: 2 ** 14 registers of the distinct sketch: a relative error of about 0.8 percent.
DISTINCT_BITS = 14
#: Size of the rank sketch: an error of about 0.1 percent of the ranks.
RANK_SIZE = 4_096
SCHEMA = "part string, feature string, n long, n_missing long, distinct_sketch binary, rank_sketch binary"


def part_sketches(df: DataFrame, part: Column, columns: Sequence[str]) -> DataFrame:
    """(part, feature, n, n_missing, distinct_sketch, rank_sketch): one row per part and column.

    One scan, and one shuffle of a sketch per task, part and column. Nulls and NaN are missing.
    Equal values are equal texts, as in the exact counts. Columns that are no numbers have no ranks.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            _present(df, c).alias("value"),
            (as_double(quoted(c)) if c in numeric else F.lit(None).cast("double")).alias("number"),
        )
        for c in columns
    ]
    long = df.select(part.cast("string").alias("part"), F.inline(F.array(*entries)))
    return long.groupBy("part", "feature").agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.hll_sketch_agg("value", DISTINCT_BITS).alias("distinct_sketch"),
        F.when(F.count("number") > 0, F.kll_sketch_agg_double("number", F.lit(RANK_SIZE))).alias("rank_sketch"),
    )


def _present(df: DataFrame, column: str) -> Column:
    text = value_text(df, column)
    return F.when(text != "NaN", text) if dict(df.dtypes)[column] in ("float", "double") else text


def merged_counts(sketches: DataFrame) -> DataFrame:
    """(feature, n, n_missing, n_distinct) over all parts; the distinct number is an estimate."""
    return sketches.groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.sum("n_missing").alias("n_missing"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch", F.lit(True))).alias("n_distinct"),
    )


def merged_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(feature, share, value) over all parts for the columns that are numbers."""
    ranks = F.array(*[F.lit(float(s)) for s in shares])
    merged = (
        sketches.filter("rank_sketch is not null")
        .groupBy("feature")
        .agg(F.kll_merge_agg_double("rank_sketch").alias("merged"))
    )
    values = F.kll_sketch_get_quantile_double("merged", ranks)
    return merged.select("feature", F.inline(F.arrays_zip(ranks.alias("share"), values.alias("value"))))


@dataclass(frozen=True)
class SketchStore:
    """Sketches below a path, a folder per part."""

    spark: SparkSession
    path: str

    def add(self, df: DataFrame, part: Column, columns: Sequence[str]) -> None:
        """Summarise the parts that ``df`` has; what the store held of these parts is replaced."""
        found = part_sketches(df, part, columns)
        writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("part").parquet(self.path)

    def sketches(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of all parts, or of those asked for; others are not read."""
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        return rows if parts is None else rows.filter(F.col("part").isin(list(parts)))

    def counts(self, parts: Sequence[str] | None = None) -> DataFrame:
        return merged_counts(self.sketches(parts))

    def quantiles(self, shares: Sequence[float], parts: Sequence[str] | None = None) -> DataFrame:
        return merged_quantiles(self.sketches(parts), shares)
