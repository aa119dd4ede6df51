"""Hand-made rows with literal expected values, one group per semantic trap."""

import math

import pytest
from pyspark.sql import functions as F

from rowsmith.fixed_values import COMPASS_POINTS, WEATHER_PATTERNS
from rowsmith.functions import dates, numbers, text
from rowsmith.operators import columns as cols
from rowsmith.operators import correlate, counts, encode, features, filters, metrics
from rowsmith.operators import missing, models, ordering, quantiles, split
from rowsmith.operators.lookup import KeyTable, attach, broadcastable


def one(df, column, order="id"):
    return [r[column] for r in df.orderBy(order).collect()]


@pytest.mark.parametrize(
    "weather, last, first",
    [
        ("Heavy Rain", "Heavy_Rain", "Rain"),
        ("Fog / Rain", "Fog", "Rain"),
        ("Squalls", "Heavy_Snow", "Heavy_Snow"),
        ("T-Storm", "Rain", "Rain"),
        ("OVERCAST", "Cloud", "Cloud"),
        ("Fair", None, "Unknown"),
        (None, None, "Unknown"),
    ],
)
def test_weather_precedence(spark, weather, last, first):
    df = spark.createDataFrame([(weather,)], "w string").select(
        text.bucket_last(F.col("w"), WEATHER_PATTERNS).alias("last"),
        text.bucket_first(F.col("w"), WEATHER_PATTERNS).alias("first"),
    )
    assert tuple(df.first()) == (last, first)
    filled = missing.fill_text(df, ["last"]).first()["last"]
    assert filled == (last or "Unknown")


def test_compass_map_passes_others_through(spark):
    winds = ["North", "NNE", "ENE", "NNW", "Calm", "X", None]
    df = spark.createDataFrame(list(enumerate(winds)), "id int, w string")
    mapped = cols.map_values(df, COMPASS_POINTS, ["w"])
    assert one(mapped, "w") == ["N", "NE", "E", "NW", "CALM", "X", None]


@pytest.mark.parametrize(
    "base, expected",
    [(0, (0, "Evening", "Night")), (1, (1, "Night", "Day"))],
)
def test_midnight_by_hour_base(spark, base, expected):
    moment = F.to_timestamp(F.lit("2024-01-01 00:10:00"))
    hour = dates.hour_of(moment, base)
    row = spark.range(1).select(hour, dates.part_of_day(hour), dates.day_flag(hour)).first()
    assert tuple(row) == expected


def test_midnight_in_bins_and_open_flag(spark):
    row = spark.range(1).select(
        dates.part_of_day_bins(F.lit(0)),
        dates.day_flag(F.lit(0), None),
        dates.part_of_day_bins(F.lit(None).cast("int")),
        dates.part_of_day_bins(F.lit(24)),
    )
    assert tuple(row.first()) == ("Night", "Day", "Unknown", "Evening")


def test_bad_and_null_times(spark):
    times = ["bad", None, "2016-02-08 05:46:00", "2016-02-08 05:46:00.000000001"]
    df = spark.createDataFrame(list(enumerate(times)), "id int, t string")
    df = df.withColumn("ts", dates.parse_timestamp(F.col("t")))
    hour = dates.hour_of(F.col("ts"))
    df = df.withColumns({"h": hour, "p": dates.part_of_day(hour), "d": dates.day_flag(hour)})
    assert one(df, "h") == [None, None, 5, 5]
    assert one(df, "p") == ["Evening", "Evening", "Night", "Night"]
    assert one(df, "d") == ["Night", "Night", "Day", "Day"]


def test_monday(spark):
    monday = F.to_timestamp(F.lit("2024-01-01 12:00:00"))
    row = spark.range(1).select(dates.day_of_week(monday), dates.day_of_week(monday, True))
    assert tuple(row.first()) == (2, 1)


@pytest.mark.parametrize("broadcast_bytes", [0, 2**20])
@pytest.mark.parametrize("policy, expected", [("drop", [2, 2, 1, None]), ("count", [2, 2, 1, 1])])
def test_frequency_of_null(spark, policy, expected, broadcast_bytes):
    rows = [(0, "A"), (1, "A"), (2, "B"), (3, None)]
    df = spark.createDataFrame(rows, "id int, County string")
    encoder = encode.FrequencyEncoder.fit(df, ["County"], policy, broadcast_bytes=broadcast_bytes)
    encoded = encoder.transform(df)
    assert encoded.columns == ["id", "County_freq"]
    assert one(encoded, "County_freq") == expected


def test_frequency_of_unseen_value(spark):
    train = spark.createDataFrame([("A",), ("A",)], "c string")
    test = spark.createDataFrame([(0, "A"), (1, "Z")], "id int, c string")
    assert one(encode.FrequencyEncoder.fit(train, ["c"]).transform(test), "c_freq") == [2, None]
    with_null = test.union(spark.createDataFrame([(2, None)], "id int, c string"))
    for policy, expected in (("drop", [2, 0, None]), ("count", [2, 0, 0])):
        encoder = encode.FrequencyEncoder.fit(train, ["c"], policy, unseen_as_zero=True)
        assert one(encoder.transform(with_null), "c_freq") == expected


@pytest.fixture
def shuffled_joins(spark):
    """Let no join be turned into a broadcast and no shuffle partitions be merged."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("policy", ["drop", "count"])
def test_frequency_of_hot_key(spark, shuffled_joins, policy):
    """A third of the rows share one key and others have none; no partition is much larger."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1)
    df = spark.range(30_000).select("id", F.when(F.col("id") % 7 != 0, key).alias("k"))
    wide = encode.FrequencyEncoder.fit(df, ["k"], policy, broadcast_bytes=2**20).transform(df)
    spread = encode.FrequencyEncoder.fit(df, ["k"], policy, broadcast_bytes=0).transform(df)
    assert "SortMergeJoin" in spread._jdf.queryExecution().executedPlan().toString()
    assert spread.count() == 30_000
    assert wide.exceptAll(spread).count() == 0
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * 30_000 / 8


def test_shuffled_split_and_index(spark, shuffled_joins):
    df = spark.range(6_000).withColumn("label", F.concat(F.lit("L"), F.pmod(F.hash("id"), F.lit(40))))
    marks = [
        split.stratified_split(df, "label", "id", broadcast_bytes=size, boundary_rows=rows)
        for size, rows in ((2**20, 100_000), (0, 3))
    ]
    assert marks[0].exceptAll(marks[1]).count() == 0
    indexed = [
        encode.LabelIndexer.fit(df, ["label"], ranked_labels=n, broadcast_bytes=size).transform(df)
        for n, size in ((100, 2**20), (0, 0))
    ]
    assert indexed[0].exceptAll(indexed[1]).count() == 0
    assert indexed[1].count() == 6_000


@pytest.mark.parametrize("ranked_labels", [0, 100])
@pytest.mark.parametrize(
    "order, expected",
    [("frequency", [0.0, 0.0, 2.0, 1.0, 3.0]), ("alphabet", [2.0, 2.0, 1.0, 0.0, 3.0])],
)
def test_label_index(spark, order, expected, ranked_labels):
    rows = list(enumerate(["c", "c", "b", "a", None]))
    df = spark.createDataFrame(rows, "id int, label string")
    indexer = encode.LabelIndexer.fit(df, ["label"], order, ranked_labels=ranked_labels)
    assert one(indexer.transform(df), "label_idx") == expected
    unseen = spark.createDataFrame([(0, "zz")], "id int, label string")
    assert one(indexer.transform(unseen), "label_idx") == [3.0]


def test_label_index_agrees_with_mllib(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(1000).select("id", F.concat(F.lit("L"), (F.col("id") ** 2 % 37).cast("int")).alias("c"))
    for ours, theirs in (("frequency", "frequencyDesc"), ("alphabet", "alphabetAsc")):
        indexed = encode.LabelIndexer.fit(df, ["c"], ours).transform(df, keep_source=True)
        model = StringIndexer(inputCol="c", outputCol="e", stringOrderType=theirs).fit(df)
        assert model.transform(indexed).filter("e <> c_idx").count() == 0


def test_label_index_skips_and_rejects(spark):
    df = spark.createDataFrame([(0, "a"), (1, None)], "id int, c string")
    skipped = encode.LabelIndexer.fit(df, ["c"], handle_invalid="skip").transform(df)
    assert one(skipped, "id") == [0]
    kept_null = encode.LabelIndexer.fit(df, ["c"], handle_invalid="null").transform(df)
    assert one(kept_null, "c_idx") == [0.0, None]
    with pytest.raises(ValueError):
        encode.LabelIndexer.fit(df, ["c"], order="size")
    with pytest.raises(ValueError):
        encode.FrequencyEncoder.fit(df, ["c"], null_policy="zero")


def test_random_split_is_repeatable_and_near_its_share(spark):
    df = spark.range(10_000)
    first, second = (split.random_split(d, "id") for d in (df, df.repartition(5)))
    assert first.exceptAll(second).count() == 0
    assert 6_800 < first.filter("split = 'train'").count() < 7_200


@pytest.mark.parametrize("boundary_rows", [0, 100_000])
def test_stratified_split_is_exact(spark, boundary_rows):
    df = spark.range(10_000).withColumn("label", F.when(F.col("id") < 100, 1).otherwise(2))
    marked = split.stratified_split(df, "label", "id", boundary_rows=boundary_rows)
    train, test = split.parts(marked)
    found = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    assert found == {1: 70, 2: 6_930}
    assert test.count() == 3_000
    by_window = df.selectExpr(
        "id", "label", "row_number() over (partition by label order by md5(string(id))) as rn"
    ).filter("rn <= if(label = 1, 70, 6930)")
    assert train.select("id", "label").exceptAll(by_window.select("id", "label")).count() == 0


def test_stratified_split_with_null_small_and_repeated(spark):
    rows = [(i, None) for i in range(10)] + [(100, "lone")] + [(7_000 + i // 50, "r") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, label string")
    marked = split.stratified_split(df, "label", "id")
    found = {
        (r["label"], r["split"]): r["count"] for r in marked.groupBy("label", "split").count().collect()
    }
    assert found == {(None, "train"): 7, (None, "test"): 3, ("lone", "test"): 1,
                     ("r", "train"): 350, ("r", "test"): 150}
    sides = marked.groupBy("id").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0


PAIRS = [(1.0, 2.0), (2.0, None), (3.0, 6.5), (4.0, 7.0)]


def test_correlation_of_nulls_and_constants(spark):
    df = spark.createDataFrame(PAIRS, "x double, Label double").withColumn("one", F.lit(1))
    found = {r[0]: r[1] for r in correlate.label_correlation(df, "label").collect()}
    assert set(found) == {"x", "one"}
    assert found["x"] == pytest.approx(0.970725, abs=1e-6)
    assert found["one"] is None
    zero = correlate.label_correlation(df, "label", ["x"], null_as_zero=True).first()
    assert zero["correlation"] == pytest.approx(0.810456, abs=1e-6)
    assert zero["correlation"] == pytest.approx(df.stat.corr("x", "Label"), abs=1e-12)
    ranked = correlate.rank_features(correlate.label_correlation(df, "label"))
    assert [r["feature"] for r in ranked.collect()] == ["x"]


def test_unreadable_number_becomes_null(spark):
    df = spark.createDataFrame([("1.5", "tcp"), ("x", "udp")], "n string, p string")
    cast = cols.cast_to_double(df, keep=["p"])
    assert [tuple(r) for r in cast.orderBy("p").collect()] == [(1.5, "tcp"), (None, "udp")]


def test_mean_fill_of_integers_and_nan(spark):
    ints = spark.createDataFrame([(0, 1), (1, 2), (2, None)], "id int, x int")
    assert one(missing.fill_mean(ints, ["x"]), "x") == [1.0, 2.0, 1.5]
    floats = spark.createDataFrame([(0, 1.0), (1, math.nan), (2, None)], "id int, x double")
    assert one(missing.fill_mean(floats, ["x"]), "x") == [1.0, 1.0, 1.0]
    assert one(missing.NumericFill.fit(floats, ["x"]).transform(floats), "x") == [1.0, 1.0, 1.0]


def test_median_fill(spark):
    df = spark.createDataFrame([(0, 1), (1, 4), (2, None), (3, 9), (4, 2)], "id int, x int")
    assert one(missing.fill_median(df, ["x"]), "x") == [1.0, 4.0, 3.0, 9.0, 2.0]
    with pytest.raises(ValueError):
        missing.NumericFill.fit(df, ["x"], "mode")


@pytest.mark.parametrize("ranked_values, grid", [(10, 20), (10, 1000), (100_000, 1000)])
def test_medians_are_exact(spark, ranked_values, grid):
    x = F.col("id")
    df = spark.range(10_001).select(
        (x * 7919 % 10_007).alias("spread"),
        F.when(x % 3 == 0, 5).otherwise(x).alias("tied"),
        F.exp(x / 100).alias("steep"),
        F.when(x % 2 == 0, x / 3).alias("holes"),
        F.lit(None).cast("double").alias("empty"),
        F.lit(4).alias("constant"),
    )
    found = quantiles.medians(df, df.columns, ranked_values, grid)
    found = {r["feature"]: r["median"] for r in found.collect()}
    expected = df.agg(*[F.median(c).alias(c) for c in df.columns]).first().asDict()
    assert found == pytest.approx(expected)


def test_flags(spark):
    df = spark.createDataFrame([(0, True), (1, False), (2, None)], "id int, b boolean")
    assert one(encode.binary_flags(df, ["b", "absent"]), "b_bin") == [1, 0, 0]
    texts = [" Day ", "DAY", "yes", "1", "no", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    assert one(encode.binary_flags(df, ["t"]), "t_bin") == [0, 1, 1, 1, 0, 0]
    assert one(encode.binary_flags(df, ["t"], trim=True), "t_bin") == [1, 1, 1, 1, 0, 0]


def test_binary_label(spark):
    df = spark.createDataFrame([(0, "normal"), (1, "smurf"), (2, None)], "id int, o string")
    df = df.withColumn("o", text.binary_label(F.col("o"), "normal"))
    assert one(df, "o") == [0, 1, 1]


def test_nan_text(spark):
    df = spark.createDataFrame([(0, math.nan), (1, None), (2, 1.0)], "id int, x double")
    assert one(missing.replace_nan_text(df, ["x"]), "x") == ["Unknown", "Unknown", "1.0"]


def test_one_hot_limits_and_nulls(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "id int, c string")
    encoded = encode.one_hot(df, ["c"])
    assert encoded.columns == ["id", "c_a", "c_b"]
    assert [tuple(r)[1:] for r in encoded.orderBy("id").collect()] == [(1, 0), (0, 1), (0, 0)]
    given = encode.one_hot(df, ["c"], categories={"c": ["b"]})
    assert [tuple(r)[1:] for r in given.orderBy("id").collect()] == [(0,), (1,), (0,)]


def test_one_hot_has_no_limit(spark):
    df = spark.range(1_001).select((F.col("id") + 10_000).cast("string").alias("c"))
    encoded = encode.one_hot(df, ["c"], keep_source=True)
    assert len(encoded.columns) == 1_002
    row = encoded.filter("c = '10500'").first()
    assert row["c_10500"] == 1 and sum(row[c] for c in encoded.columns[1:]) == 1


def test_group_lists_keep_every_value(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 50).alias("k"))
    lists = counts.group_lists(df, "k", "id", "id", chunk_rows=30)
    assert lists.agg(F.max("chunks")).first()[0] == 14
    values = lists.select("k", F.explode("values").alias("id"))
    assert values.exceptAll(df.select("k", "id")).count() == 0
    assert values.count() == 1000


def test_row_numbers(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("x"))
    numbered = ordering.row_numbers(df, [F.col("x").desc()], "position")
    expected = df.selectExpr("x", "row_number() over (order by x desc) - 1 as position")
    assert numbered.exceptAll(expected).count() == 0
    assert numbered.count() == 5000


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(0, 5.0, 1.0), (1, 5.0, 3.0)], "id int, c double, x double")
    for scaled in (
        features.scale_columns(df, ["c", "x"]),
        features.ColumnScaler.fit(df, ["c", "x"]).transform(df),
    ):
        assert one(scaled, "c") == [0.0, 0.0]
        assert one(scaled, "x") == pytest.approx([-0.70710678, 0.70710678])
    population = features.scale_columns(df, ["x"], population=True)
    assert one(population, "x") == pytest.approx([-1.0, 1.0])


def test_metrics(spark):
    rows = [(1, 1.0)] * 3 + [(2, 1.0), (2, 2.0)]
    df = spark.createDataFrame(rows, "label int, prediction double")
    row = metrics.classification_metrics(df, "label").first()
    assert row["accuracy"] == pytest.approx(0.8)
    assert row["weighted_f1"] == pytest.approx(0.780952, abs=1e-6)
    assert row["macro_f1"] == pytest.approx(0.761905, abs=1e-6)
    assert metrics.accuracy(df, "label").first()[0] == pytest.approx(0.8)


def test_metrics_agree_with_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    df = spark.range(6000).select(
        (F.col("id") * 7919 % 3 + 1).cast("int").alias("label"),
        (F.col("id") * 104729 % 5 % 3 + 1).cast("double").alias("prediction"),
    )
    ours = metrics.classification_metrics(df, "label").first()
    evaluator = MulticlassClassificationEvaluator(labelCol="label")
    assert ours["weighted_f1"] == pytest.approx(evaluator.setMetricName("f1").evaluate(df))
    assert ours["accuracy"] == pytest.approx(evaluator.setMetricName("accuracy").evaluate(df))
    scored = spark.range(6000).select(
        (F.col("id") * 7919 % 2).cast("int").alias("label"),
        (F.floor(F.sqrt(F.col("id") * 31 % 5003) * 40) / 40 + F.col("id") % 2).alias("score"),
    )
    assert scored.select("score").distinct().count() > 1000
    area = metrics.area_under_roc(scored, "label", "score").first()[0]
    exact = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert area == pytest.approx(exact.evaluate(scored), abs=1e-12)


def test_area_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5)], "label int, score double")
    assert metrics.area_under_roc(df, "label", "score").first()[0] is None


def test_labels_from_one_keep_an_empty_class(spark):
    df = spark.range(2000).select(
        (F.col("id") % 100 / 25).cast("int").alias("x"), (F.col("id") % 100 / 25 + 1).cast("int").alias("y")
    )
    model = models.fit_model(df, ["x"], models.forest("y", numTrees=3, maxDepth=4))
    assert model.stages[-1].numClasses == 5
    assert metrics.accuracy(model.transform(df), "y").first()[0] > 0.99


def test_incomplete_rows(spark):
    rows = [(0, 1.0, 1), (1, math.nan, 1), (2, None, 1), (3, 1.0, None)]
    df = spark.createDataFrame(rows, "id int, x double, y int")
    assert one(filters.drop_incomplete(df, ["x", "y"]), "id") == [0]
    assert tuple(filters.incomplete_counts(df, ["x", "y"]).first()) == (4, 1, 3)
    infinite = spark.createDataFrame([(0, math.inf), (1, -math.inf), (2, 2.0), (3, None)], "id int, x double")
    assert one(filters.replace_infinite(infinite, ["x"]), "x") == [None, None, 2.0, None]


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "severity int")
    weights = {r["severity"]: r["weight"] for r in counts.class_weights(df, "severity").collect()}
    assert weights == {1: pytest.approx(4 / 3), 2: 4.0}
    weighted = counts.with_class_weight(df, "severity")
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(8.0)


def test_single_valued_columns(spark):
    df = spark.createDataFrame([("US", "a", None), ("US", "b", "x")], "c string, d string, e string")
    assert counts.CategoryCounts.fit(df, ["c", "d", "e"]).single_valued() == ["c", "e"]
    assert counts.drop_constant(df, ["c", "d", "e"]).columns == ["d"]
    approximate = counts.distinct_counts(df, ["c", "d"], approximate=True)
    assert {tuple(r) for r in approximate.collect()} == {("c", 1), ("d", 2)}


def test_broadcast_budget_is_shared():
    assert broadcastable({"a": 60, "b": 50, "c": 10}, 100) == {"b", "c"}
    assert broadcastable({"a": 60}, 0) == set()


def test_dictionary_lookup_beyond_broadcast(spark):
    words = spark.range(1000).select(F.col("id").cast("string").alias("w"), (F.col("id") * 2).alias("v"))
    dictionary = KeyTable.of_values(words, "w", ("v",))
    df = spark.createDataFrame([(0, "7"), (1, "none"), (2, None)], "id int, w string")
    assert one(attach(df, F.col("w"), dictionary, broadcast_bytes=0), "v") == [14, None, None]


def test_hash_numbers_stay_in_range(spark):
    df = spark.range(2000).select(
        numbers.hash_integer(F.col("id"), 70).alias("i"), numbers.hash_uniform(F.col("id")).alias("u")
    )
    low, high, least, most = df.agg(F.min("i"), F.max("i"), F.min("u"), F.max("u")).first()
    assert (low, high) == (0, 69)
    assert 0 <= least < 0.01 and 0.99 < most < 1
