"""Both jobs from end to end on derived records."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rowsmith import fixed_values as fixed
from rowsmith.operators import split
from rowsmith.plans import intrusion, severity
from rowsmith.sources.delimited import read_delimited
from rowsmith.plans.catalog.derived_records import accident_records, intrusion_records


@pytest.fixture(scope="module")
def accidents(spark):
    events = spark.range(4000).selectExpr(
        "id as event_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 17 * cast(id as int)) as ts",
    )
    return accident_records(events)


@pytest.fixture(scope="module")
def table(accidents):
    return severity.features(accidents)


def test_records_have_the_file_columns(accidents):
    assert accidents.columns == [f.split()[0].strip("`") for f in fixed.ACCIDENT_SCHEMA.split(",")]


def test_features(accidents, table):
    assert set(fixed.ACCIDENT_FEATURES) <= set(table.columns)
    assert not set(fixed.ACCIDENT_LOW_CORRELATION) & set(table.columns)
    assert not set(fixed.ACCIDENT_UNUSED) & set(table.columns)
    assert table.count() == 4000
    null_counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in table.columns]
    nulls = table.agg(*null_counts).first().asDict()
    bad_times = accidents.filter("Start_Time is null or Start_Time = 'bad'").count()
    assert {c: n for c, n in nulls.items() if n} == dict.fromkeys(["Hour", "Month", "Year"], bad_times)


def test_inferred_types_give_the_same_rows(spark, accidents, tmp_path):
    accidents.write.csv(str(tmp_path / "a"), header=True)
    declared = severity.clean(read_delimited(spark, str(tmp_path / "a"), fixed.ACCIDENT_SCHEMA))
    good = accidents.filter("Start_Time <> 'bad'")
    good.write.csv(str(tmp_path / "b"), header=True)
    raw = read_delimited(spark, str(tmp_path / "b"))
    assert dict(raw.dtypes)["Start_Time"].startswith("timestamp")
    inferred = severity.clean(raw)
    assert inferred.exceptAll(declared.select(inferred.columns)).count() == 0
    assert severity.clean(accidents).exceptAll(declared).count() == 0


def test_split_is_exact(table):
    rows = table.groupBy("Severity").agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count("*").alias("n")
    )
    for row in rows.collect():
        assert row["train"] == row["n"] * 7 // 10


def test_severity_models_learn(table):
    options = severity.SeverityOptions(logistic=(("maxIter", 15),))
    _, fitted, test = severity.train_models(table, options)
    assert test.filter("Hour is null").count() == 0
    from rowsmith.operators.metrics import accuracy

    scores = {n: accuracy(m.transform(test), "Severity").first()[0] for n, m in fitted.items()}
    assert scores["RandomForest"] > 0.8
    assert scores["LogisticRegression"] > 0.65


SMALL_MODELS = {
    "forest": (("numTrees", 3), ("maxDepth", 5)),
    "logistic": (("maxIter", 5),),
}


@pytest.mark.parametrize("name", ["notebook", "single_machine", "single_machine_short"])
def test_severity_variants(accidents, name):
    options = replace(severity.VARIANTS[name], **SMALL_MODELS)
    metrics = severity.run(accidents, options)
    assert metrics.count() == 6
    assert metrics.filter("value > 0.3").count() == 6


def test_variant_features(accidents):
    table = severity.features(accidents, severity.VARIANTS["single_machine"])
    names = severity.feature_names(table, severity.VARIANTS["single_machine"])
    assert {"Weather_Condition_Unknown", "Timezone_US/Pacific", "Part_of_Day_idx"} <= set(names)
    assert "Weather_Condition_Heavy_Rain" not in names
    assert {"Severity", "split", "ID", "Day"}.isdisjoint(names)
    short = severity.features(accidents, severity.VARIANTS["single_machine_short"])
    assert {"Weather_Condition_idx", "Timezone_idx"} <= set(short.columns)
    assert short.filter("Timezone_idx is null").count() == 0
    assert short.filter("County_freq is null").count() == accidents.filter("County is null").count()


def test_unknown_options_are_rejected():
    with pytest.raises(ValueError):
        severity.SeverityOptions(weather_match="both")


def test_weighted_models_fitted_on_train(accidents):
    options = severity.SeverityOptions(
        null_policy="count", fit_on="train", split="random", class_weights=True, **SMALL_MODELS
    )
    metrics = severity.run(accidents, options)
    assert metrics.filter("value > 0.3").count() == 6


def test_command_line(spark, accidents, tmp_path):
    from rowsmith.__main__ import main

    accidents.write.csv(str(tmp_path / "accidents"), header=True)
    main(["severity", str(tmp_path / "accidents"), str(tmp_path / "out"), "--variant", "notebook"])
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out" / "lines")).collect()]
    assert len(lines) == 10 and any(line.startswith("RandomForest accuracy: 0.") for line in lines)
    assert any(line.startswith("LogisticRegression training_seconds: ") for line in lines)
    rows = {(r["model"], r["metric"]): r["value"] for r in spark.read.parquet(str(tmp_path / "out" / "table")).collect()}
    options = severity.VARIANTS["notebook"]
    read = read_delimited(spark, str(tmp_path / "accidents"), fixed.ACCIDENT_SCHEMA)
    table = severity.features(read, options)
    whole = table.dropna(subset=severity.feature_names(table, options)).count()
    assert rows["all", "skipped_train_rows"] + rows["all", "skipped_test_rows"] == 4000 - whole > 0
    main(["readings", "500", str(tmp_path / "readings")])
    assert spark.read.parquet(str(tmp_path / "readings" / "totals")).count() == 70


def test_train_statistics_do_not_see_the_test_rows(accidents):
    options = severity.SeverityOptions(fit_on="train")
    table = severity.features(accidents, options)
    train = table.filter(F.col("split") == split.TRAIN)
    biggest = train.agg(F.max("State_freq")).first()[0]
    assert biggest < accidents.filter("State = 'CA'").count()


def test_intrusion(spark, tmp_path):
    events = spark.range(2000).selectExpr("id as event_id", "current_timestamp() as ts")
    records = intrusion_records(events)
    train = records.filter("row_id % 10 < 7").drop("row_id")
    test = records.filter("row_id % 10 >= 7").drop("row_id")
    train.write.csv(str(tmp_path / "train"))
    read = intrusion.read(spark, str(tmp_path / "train"))
    cleaned = intrusion.clean(read)
    assert len(intrusion.feature_names(cleaned)) == 38
    assert len(intrusion.feature_names(cleaned, with_difficulty=True)) == 39
    assert intrusion.run(read, test).first()["value"] > 0.95


def test_intrusion_bad_number(spark):
    events = spark.range(400).selectExpr("id as event_id", "current_timestamp() as ts")
    records = intrusion_records(events).drop("row_id")
    planted = records.withColumn("duration", F.when(F.rand(1) < 0.1, "bad").otherwise(F.col("duration")))
    assert intrusion.clean(planted).filter("duration is null").count() > 0
    assert intrusion.run(planted, planted, handle_invalid="skip").first()["value"] > 0.9


def test_intrusion_command_line(spark, tmp_path):
    from rowsmith.__main__ import main

    events = spark.range(600).selectExpr("id as event_id", "current_timestamp() as ts")
    records = intrusion_records(events).drop("row_id")
    planted = records.withColumn("duration", F.when(F.rand(1) < 0.1, "bad").otherwise(F.col("duration")))
    records.write.csv(str(tmp_path / "train"))
    planted.write.csv(str(tmp_path / "test"))
    main(["intrusion", str(tmp_path / "train"), str(tmp_path / "test"), str(tmp_path / "out"), "--handle-invalid", "skip"])
    found = {r["metric"]: r["value"] for r in spark.read.parquet(str(tmp_path / "out" / "table")).collect()}
    bad = spark.read.csv(str(tmp_path / "test")).filter("_c0 = 'bad'").count()
    assert found["auc"] > 0.9 and found["training_seconds"] > 0 and found["skipped_test_rows"] == bad


def test_population_scaling(spark):
    from pyspark.ml.functions import vector_to_array

    from rowsmith.operators.models import SCALED, fit_preparation

    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "x double")
    fitted = fit_preparation(df, ["x"], population=True).transform(df)
    values = [r[0][0] for r in fitted.select(vector_to_array(SCALED)).collect()]
    assert sum(v * v for v in values) == pytest.approx(3)


def test_area_of_saturated_scores(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    from rowsmith.operators import metrics

    n = F.col("id")
    margin = (n * 37 % 101 + 40).cast("double")
    df = spark.range(400).select(
        F.when(n % 3 == 0, 1).otherwise(0).alias("label"),
        array_to_vector(F.array(-margin, margin)).alias("rawPrediction"),
    )
    area = metrics.area_under_roc(metrics.positive_score(df), "label", "score").first()[0]
    expected = BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert area == pytest.approx(expected)


@pytest.mark.parametrize("weight", [None, "w"])
def test_no_training_task_keeps_all_rows(spark, monkeypatch, weight):
    from rowsmith.operators import models

    n = F.col("id")
    df = spark.range(0, 1000, 1, 1).select((n % 10).cast("double").alias("x"), (n % 10 < 5).cast("int").alias("y"), F.lit(2.0).alias("w"))
    assert models.training_rows(df, ["x"], ["y"]) is df
    row_bytes = models.ROW_BYTES + models.FEATURE_BYTES
    monkeypatch.setattr(models, "TASK_BYTES", 300 * row_bytes)
    others = ["y", "w"] if weight else ["y"]
    dealt = models.training_rows(df, ["x"], others)
    assert sorted(dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) == [100, 300, 300, 300]
    assert dealt.exceptAll(df.select("x", *others)).count() == 0
    read = []
    fit = models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows: read.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    model = models.fit_model(df, ["x"], models.forest("y", weight, numTrees=2, maxDepth=2))
    assert read == [4] and model.transform(df).filter("prediction = y").count() == 1000


def test_severity_training_is_dealt_to_tasks(accidents, monkeypatch):
    from rowsmith.operators import models

    table = severity.features(accidents)
    read = []
    fit = models.Pipeline.fit
    monkeypatch.setattr(models, "TASK_BYTES", 1000 * models.ROW_BYTES)
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows: read.append(rows.rdd.glom().map(len).max()) or fit(self, rows))
    options = severity.SeverityOptions(**SMALL_MODELS)
    _, fitted, test = severity.train_models(table, options)
    assert read[0] <= 1000 and set(fitted) == {"RandomForest", "LogisticRegression"}
    assert test.count() + table.filter("split = 'train'").count() > 3000


def test_intrusion_files_are_parsed_once(spark, tmp_path):
    from rowsmith.plans.catalog import ENTRIES

    n = F.col("id")
    orders = spark.range(1, 401).select(
        n.alias("o_orderkey"), (n % 37).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (n * 1250).cast("double").alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = ENTRIES["intrusion_job"].run(spark, str(tmp_path))
    assert "Scan csv" not in found._jdf.queryExecution().executedPlan().toString()
    values = {r["metric"]: r["value"] for r in found.collect()}
    assert values["auc"] == values["auc_of_written_scores"] == 1.0
    assert values["train_rows"] + values["test_rows"] == 400
