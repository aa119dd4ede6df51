"""Stored sketches, passes over the data, and shuffles that are not needed."""

import math

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import metrics, missing, quantiles, sketches


def days(spark, first, last):
    n = F.col("id")
    return spark.range(first * 1_000, last * 1_000).select(
        F.floor(n / 1_000).alias("day"), (n * 37 % 1_000).alias("key"), (n % 1_000 / 10).alias("x"),
        F.when(n % 4 != 0, F.concat(F.lit("t"), n)).alias("name"),
        F.when(n % 5 == 0, math.nan).when(n % 5 != 1, F.lit(-0.0)).otherwise(0.0).alias("zero"),
    )


COLUMNS = ["key", "x", "name", "zero"]


def summary(store, parts=None):
    return {r["feature"]: (r["n"], r["n_missing"], r["n_distinct"]) for r in store.counts(parts).collect()}


def test_a_new_day_reads_no_other_and_a_repeated_day_counts_once(spark, tmp_path):
    store = sketches.SketchStore(spark, str(tmp_path / "store"))
    for first, last in ((0, 3), (3, 4)):
        store.add(days(spark, first, last), F.col("day"), COLUMNS)
    before = summary(store)
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    store.add(days(spark, 3, 4), F.col("day"), COLUMNS)
    assert summary(store) == before
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    assert {p: t for p, t in old.items() if "part=3" not in str(p)} == {p: t for p, t in now.items() if "part=3" not in str(p)}
    assert before["key"][:2] == (4_000, 0) and before["key"][2] == pytest.approx(1_000, rel=0.03)
    assert before["name"][:2] == (3_000, 1_000) and before["name"][2] == pytest.approx(3_000, rel=0.03)
    assert before["zero"] == (3_200, 800, 1)
    one = summary(store, ["2"])
    assert one["name"][:2] == (750, 250) and one["name"][2] == pytest.approx(750, rel=0.03)


def test_merged_quantiles(spark, tmp_path):
    store = sketches.SketchStore(spark, str(tmp_path / "store"))
    for day in range(4):
        store.add(days(spark, day, day + 1), F.col("day"), COLUMNS)
    found = {(r["feature"], r["share"]): r["value"] for r in store.quantiles([0.25, 0.5]).collect()}
    assert set(found) == {(c, s) for c in ("key", "x", "zero") for s in (0.25, 0.5)}
    assert found["x", 0.5] == pytest.approx(50, abs=1) and found["key", 0.25] == pytest.approx(250, abs=10)
    empty = sketches.part_sketches(days(spark, 0, 0), F.col("day"), COLUMNS)
    assert sketches.merged_counts(empty).collect() == sketches.merged_quantiles(empty, [0.5]).collect() == []


def seen_by(df):
    """``df`` and a counter of the rows that jobs read of it."""
    counter = df.sparkSession.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            counter.add(len(frame))
            yield frame

    return df.mapInPandas(count, df.schema), counter


@pytest.mark.parametrize("ranked_values, scans", [(100, 3), (100_000, 2)])
def test_medians_scan_three_times(spark, ranked_values, scans):
    n = 20_000
    x = F.col("id")
    df = spark.range(n).select(
        (x * 7919 % 10_007).cast("double").alias("spread"), F.exp(x / 1_000).alias("steep"), F.when(x % 2 == 0, 0.0).otherwise(x).alias("half"),
        F.when(x % 3 != 0, x / 7).alias("holes"),
    )
    counted, counter = seen_by(df)
    found = {r["feature"]: r["median"] for r in quantiles.medians(counted, df.columns, ranked_values, 100).collect()}
    assert counter.value <= scans * n
    assert found == pytest.approx(df.agg(*[F.median(c).alias(c) for c in df.columns]).first().asDict())


def test_median_fill_learns_in_three_scans(spark):
    n = 5_000
    df = spark.range(n).select((F.col("id") * 17 % 4_999).cast("double").alias("a"), F.when(F.col("id") % 3 != 0, F.col("id") / 3).alias("b"))
    counted, counter = seen_by(df)
    missing.NumericFill.fit(counted, ["a", "b"], "median")
    assert counter.value <= 3 * n


def test_area_under_roc_needs_two_shuffles_of_scores(spark):
    n = F.col("id")
    df = spark.range(5_000).select((n * 31 % 997 / 10.0).alias("score"), (n % 3 == 0).cast("int").alias("label"))
    bounds = metrics.score_bounds(df, "score")
    assert bounds == sorted(bounds) and 1 <= len(bounds) <= 7
    area = metrics.area_under_roc(df, "label", "score", bounds)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = metrics.area_under_roc(df, "label", "score", bounds)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("Exchange hashpartitioning") == 2 and "rangepartitioning" not in plan
    pairs = df.groupBy("score", "label").count().collect()
    negative, positive = ([(r["score"], r["count"]) for r in pairs if r["label"] == y] for y in (0, 1))
    wins = sum(p * n * (1 if a > b else 0.5 if a == b else 0) for a, p in positive for b, n in negative)
    expected = wins / sum(p for _, p in positive) / sum(n for _, n in negative)
    for chosen in (bounds, [], [3.0], [-5.0, 50.0, 1e9]):
        assert metrics.area_under_roc(df, "label", "score", chosen).first()[0] == pytest.approx(expected)
    assert area.first()[0] == pytest.approx(expected)
    nothing = df.filter("label > 5")
    assert metrics.area_under_roc(nothing, "label", "score").first()[0] is None
