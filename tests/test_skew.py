"""Heavy values, missing keys, signed zeros and hot keys."""

import math

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import counts, encode, quantiles, split
from rowsmith.operators.lookup import KeyTable, attach


@pytest.mark.parametrize("ranked_values, max_passes", [(50, 12), (50, 2), (100_000, 12)])
def test_median_ends_whatever_value_is_heavy(spark, ranked_values, max_passes):
    n = F.col("id")
    df = spark.range(20_000).select(
        F.when(n < 10_000, 0).otherwise(n).alias("half_zero"),
        F.when(n < 10_001, 0).otherwise(n).alias("more_zero"),
        F.when(n < 9_999, 0).otherwise(n).alias("less_zero"),
        F.when(n < 10_000, 1).otherwise(2).alias("two_values"),
        F.when(n % 2 == 0, -n).otherwise(n).cast("double").alias("spread"),
        F.when(n == 0, float("-inf")).when(n == 1, float("inf")).otherwise(n).alias("infinite"),
    )
    found = quantiles.medians(df, df.columns, ranked_values, 100, max_passes)
    expected = df.agg(*[F.median(c).alias(c) for c in df.columns]).first().asDict()
    assert {r["feature"]: r["median"] for r in found.collect()} == pytest.approx(expected)


@pytest.mark.parametrize("n_null", [0, 20, 75, 100])
def test_splits_with_missing_keys(spark, n_null):
    n = F.col("id")
    df = spark.range(100).select(F.when(n >= n_null, n).alias("k"), F.lit("a").alias("label"), (n * 3).alias("v"))
    marked = split.stratified_split(df, "label", "k")
    assert marked.columns == ["k", "label", "v", "split"]
    assert marked.filter("split = 'train'").count() == 70
    assert marked.drop("split").exceptAll(df).count() == 0
    drawn = split.random_split(df, "k")
    assert 55 <= drawn.filter("split = 'train'").count() <= 85


def test_signed_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0, 0.0), (1, -0.0), (2, math.nan), (3, math.nan), (4, 1.0), (5, None)], "id int, x double")
    n = df.agg(F.count_distinct("x")).first()[0]
    assert counts.distinct_counts(df, ["x"]).first()["n_distinct"] == n == 3
    encoded = encode.FrequencyEncoder.fit(df, ["x"]).transform(df).orderBy("id")
    assert [r["x_freq"] for r in encoded.collect()] == [2, 2, 2, 2, 1, None]
    zeros = df.filter("id < 2")
    assert counts.drop_constant(zeros, ["x"]).columns == ["id"]
    assert counts.drop_constant(df, ["x"]).columns == ["id", "x"]
    empty = df.filter("id = 5")
    assert counts.drop_constant(empty, ["x"]).columns == ["id", "x"]


@pytest.fixture
def shuffled(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _layouts(spark):
    n = F.col("id")
    rows = spark.range(100_000)
    mostly = F.when(n % 10 == 0, n % 997).otherwise(-1)
    yield "key column only", rows.select(mostly.alias("k"))
    yield "null key", rows.select(F.when(n % 10 == 0, n % 997).alias("k"))
    yield "just under the hot share", rows.select((n % 70).alias("k"))


def test_hot_keys_are_spread(spark, shuffled):
    for name, df in _layouts(spark):
        seen = df.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("n"))
        _check(name, df, attach(df, F.col("k"), KeyTable.measured(seen, ("v",)), True, 0), df.count())
    name, df = next(_layouts(spark))
    words = spark.range(500).select("id", (F.col("id") * 2).alias("v"))
    found = attach(df, F.col("k"), KeyTable.of_values(words, "id", ("v",)), broadcast_bytes=0)
    _check("dictionary without counts", df, found, 0)
    expected = df.join(F.broadcast(words), F.col("k") == F.col("id"), "left").select("k", "v")
    assert found.exceptAll(expected).count() == 0


def _check(name, df, found, total):
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan, name
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == df.count() and max(sizes) <= 2 * sum(sizes) / 16, (name, sorted(sizes))


def test_lists_are_never_longer_than_asked(spark):
    n = F.col("id")
    df = spark.range(700).select((n % 2).alias("k"), (n % 5).alias("v"), F.when(n % 3 == 0, 1).alias("row_id"))
    lists = counts.group_lists(df, "k", "v", "row_id", chunk_rows=100).collect()
    assert sorted(len(r["values"]) for r in lists) == [50, 50, *[100] * 6]
    whole = {}
    for r in sorted(lists, key=lambda r: (r["k"], r["chunk"])):
        assert r["chunks"] == 4
        whole.setdefault(r["k"], []).extend(r["values"])
    assert all(values == sorted(values) and len(values) == 350 for values in whole.values())
