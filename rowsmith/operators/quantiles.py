"""Exact medians of several columns without bringing their values together.

The first pass counts the values of all columns and keeps one mergeable quantile sketch of each.
Around the middle ranks the sketch gives a narrow open interval; a second pass counts exactly what
lies below, at the ends of and inside it, for all columns at once. The third ranks what is inside:
in one task per column if the values there are few, in sorted ranges if they are many. A column
with few distinct values is ranked after the first pass.

Counts are exact in every pass and the sketch decides the cost alone: an interval that misses the
middle ranks is widened and counted again. A rank that falls on the block of equal values at an end
is answered by that end, so a value that holds a large share of the rows does no harm.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from rowsmith.functions.numbers import as_double
from rowsmith.operators.columns import quoted
from rowsmith.storage import materialize

GRID = 1_000
# The sketch's rank error is about 2.3 / k, well below the width of a cell of the grid.
SKETCH_PER_CELL, SMALLEST_SKETCH, LARGEST_SKETCH = 8, 200, 65_535
RANKED_VALUES = 100_000
# Counting passes over the data: two, and one for each interval that missed.
MAX_PASSES = 12


@dataclass
class Interval:
    """Open interval of values; an end that is None is no bound."""

    low: float | None = None
    high: float | None = None

    def holds(self, x: Column) -> Column:
        inside = x.isNotNull()
        if self.low is not None:
            inside = inside & (x > self.low)
        if self.high is not None:
            inside = inside & (x < self.high)
        return inside


@dataclass
class Search:
    """Where the middle ranks of one column are known to lie."""

    settled: Interval = field(default_factory=Interval)
    trial: Interval = field(default_factory=Interval)
    below: int = 0
    inside: int = -1
    margin: int = 1
    pending: list[int] | None = None
    answers: list[float] = field(default_factory=list)
    sketch: list[float] | None = None
    in_ranges: bool = False

    def learn(self, counts: Row, ranked_values: int) -> bool:
        """Take in the counts of the trial interval; True if no further pass is needed."""
        if self.pending is None:
            self.pending = [(counts["n"] - 1) // 2, counts["n"] // 2] if counts["n"] else []
        start = counts["below"] + counts["at_low"]
        end = start + counts["inside"]
        if any(not counts["below"] <= r < end + counts["at_high"] for r in self.pending):
            # The sketch missed: try wider from the last interval that holds the ranks.
            self.margin *= 4
            self.in_ranges = self.margin > len(self.sketch)
            self._aim()
            return self.in_ranges
        self.answers += [self.trial.low for r in self.pending if r < start]
        self.answers += [self.trial.high for r in self.pending if r >= end]
        self.pending = [r for r in self.pending if start <= r < end]
        narrowed = self.sketch is not None
        self.settled, self.below, self.inside = self.trial, start, counts["inside"]
        if not self.pending or counts["distinct"] <= ranked_values:
            return True
        # What is left in a narrow interval is ranked in sorted ranges.
        self.in_ranges = narrowed
        if not narrowed:
            self.sketch = counts["sketch"]
            self._aim()
        return narrowed

    def _aim(self) -> None:
        cells = len(self.sketch) - 1
        places = [(r - self.below) / max(1, self.inside) * cells for r in self.pending]
        left = math.floor(min(places)) - self.margin
        right = math.ceil(max(places)) + self.margin
        self.trial = Interval(
            self.sketch[left] if left >= 0 else self.settled.low,
            self.sketch[right] if right <= cells else self.settled.high,
        )


def medians(
    df: DataFrame,
    columns: Sequence[str],
    ranked_values: int = RANKED_VALUES,
    grid: int = GRID,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """(feature, median) per column, null for a column without values."""
    numbers = df.select(*[as_double(quoted(c)).alias(c) for c in columns])
    found = _narrow(numbers, columns, ranked_values, grid, max_passes)
    known = df.sparkSession.createDataFrame(
        [(c, sum(s.answers) / 2) for c, s in found.items() if not s.pending and s.answers]
        + [(c, None) for c, s in found.items() if not s.pending and not s.answers],
        "feature string, median double",
    )
    near = {c: s for c, s in found.items() if s.pending and not s.in_ranges}
    far = {c: s for c, s in found.items() if s.pending and s.in_ranges}
    result = known
    if near:
        result = result.union(_ranked(numbers, near, _running_per_column))
    if far:
        result = result.union(_ranked(numbers, far, _running_in_ranges))
    return result


def _narrow(
    numbers: DataFrame, columns: Sequence[str], ranked_values: int, grid: int, max_passes: int
) -> dict[str, Search]:
    found = {c: Search() for c in columns}
    waiting = list(columns)
    for i in range(max_passes):
        if not waiting:
            break
        counts = numbers.agg(
            *[_counts(quoted(c), found[c].trial, 0 if i else grid).alias(f"c{j}") for j, c in enumerate(waiting)]
        ).first()
        waiting = [c for j, c in enumerate(waiting) if not found[c].learn(counts[j], ranked_values)]
    for c in waiting:
        found[c].in_ranges = True
    return found


def _counts(x: Column, trial: Interval, grid: int) -> Column:
    """Exact counts around a trial interval and, with a grid, the sketch of its inside."""
    inside = F.when(trial.holds(x), x)
    none = F.lit(0).cast("long")
    sketch = _grid(inside, grid) if grid else F.lit(None).cast("array<double>")
    return F.struct(
        F.count(x).alias("n"),
        (none if trial.low is None else F.count_if(x < trial.low)).alias("below"),
        (none if trial.low is None else F.count_if(x == trial.low)).alias("at_low"),
        F.count(inside).alias("inside"),
        (none if trial.high is None else F.count_if(x == trial.high)).alias("at_high"),
        F.approx_count_distinct(inside).alias("distinct"),
        sketch.alias("sketch"),
    )


def _grid(x: Column, grid: int) -> Column:
    """Values at even ranks, by a mergeable sketch; null without values."""
    k = min(LARGEST_SKETCH, max(SMALLEST_SKETCH, SKETCH_PER_CELL * grid))
    shares = F.array(*[F.lit(i / grid) for i in range(grid + 1)])
    kept = F.kll_sketch_agg_double(x, F.lit(k))
    return F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(kept, shares))


def _ranked(numbers: DataFrame, searches: dict[str, Search], running) -> DataFrame:
    """(feature, median) of columns whose middle ranks lie in a known interval, from one scan."""
    columns = list(searches)
    inside = numbers.select(
        *[F.when(s.settled.holds(quoted(c)), quoted(c)).alias(c) for c, s in searches.items()]
    )
    counts = (
        inside.unpivot([], [quoted(c) for c in columns], "feature", "x")
        .filter("x is not null")
        .groupBy("feature", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    targets = numbers.sparkSession.createDataFrame(
        [
            (c, s.pending[0] - s.below, s.pending[-1] - s.below, len(s.pending), float(sum(s.answers)))
            for c, s in searches.items()
        ],
        "feature string, first long, last long, wanted int, known double",
    )
    # The target table has one row per column asked for.
    return (
        F.broadcast(targets)
        .join(running(counts), "feature", "left")
        .groupBy("feature", "wanted", "known")
        .agg(_value_at("first").alias("one"), _value_at("last").alias("two"))
        .select("feature", _median().alias("median"))
    )


def _value_at(rank: str) -> Column:
    holds = (F.col("upto") - F.col("n") <= F.col(rank)) & (F.col(rank) < F.col("upto"))
    return F.max(F.when(holds, F.col("x")))


def _median() -> Column:
    """Mean of the two middle values, of which one may have been known before."""
    both = F.when(F.col("wanted") == 2, F.col("one") + F.col("two")).otherwise(F.col("one") + F.col("known"))
    return both / 2


def _running_per_column(counts: DataFrame) -> DataFrame:
    """(feature, x, n, upto) for columns with few values left."""
    by_value = Window.partitionBy("feature").orderBy("x")
    return counts.withColumn("upto", F.sum("n").over(by_value.rowsBetween(Window.unboundedPreceding, 0)))


def _running_in_ranges(counts: DataFrame) -> DataFrame:
    """(feature, x, n, upto), the values of all columns side by side in sorted ranges."""
    ranges = materialize(
        counts.repartitionByRange("feature", "x").withColumn("range", F.spark_partition_id()), "ranked_ranges"
    )
    earlier = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per column and range, and the number of ranges is a setting of the session.
    starts = ranges.groupBy("feature", "range").agg(F.sum("n").alias("held")).select(
        "feature", "range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start")
    )
    local = Window.partitionBy("feature", "range").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    running = ranges.withColumn("local", F.sum("n").over(local)).join(F.broadcast(starts), ["feature", "range"])
    return running.select("feature", "x", "n", (F.col("start") + F.col("local")).alias("upto"))
