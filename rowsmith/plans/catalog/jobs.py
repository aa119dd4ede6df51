"""Models on labels that follow from features, and both jobs from end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.fixed_values import ACCIDENT_SCHEMA
from rowsmith.operators import metrics, models, split
from rowsmith.operators.filters import incomplete
from rowsmith.plans import intrusion, severity
from rowsmith.plans.catalog.order_records import ATTACK_PRICE, GRADE_SQL, UNREADABLE_EVERY, accidents_of, intrusions_of
from rowsmith.plans.catalog.registry import query, table
from rowsmith.sources.delimited import read_delimited, write_delimited
from rowsmith.storage import materialize, scratch_path

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _graded(spark, folder):
    """Line items with a grade 1 to 4 that follows from price and quantity."""
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    grade = 1 + (price > 20000).cast("int") + (price > 50000).cast("int") + (quantity > 40).cast("int")
    rows = table(spark, folder, "lineitem").select(
        *NUMBERS, F.xxhash64("*").alias("key"), grade.alias("grade")
    )
    return split.parts(split.random_split(rows, "key"))


def _model_metrics(spark, folder, estimator, name):
    train, test = _graded(spark, folder)
    model = models.fit_model(train, NUMBERS, estimator)
    row = metrics.classification_metrics(model.transform(test), "grade")
    return metrics.metric_table(row, name)


@query("forest_model")
def forest_model(spark, folder):
    return _model_metrics(spark, folder, models.forest("grade"), "RandomForest")


@query("logistic_model")
def logistic_model(spark, folder):
    return _model_metrics(spark, folder, models.logistic("grade"), "LogisticRegression")


@query("binary_logistic_scores")
def binary_logistic_scores(spark, folder):
    train, test = _graded(spark, folder)
    high = (F.col("grade") > 2).cast("int")
    model = models.fit_model(
        train.withColumn("high", high), NUMBERS, models.binary_logistic("high")
    )
    return models.scores(model.transform(test.withColumn("high", high)), ["high"])


STRATIFIED = """case when row_number() over (partition by severity order by md5(id), id) * 10
    <= count(*) over (partition by severity) * 7 then 'train' else 'test' end"""
BY_HASH = "case when substr(md5('42:' || id), 1, 8) < 'b3333333' then 'train' else 'test' end"


def _severity_sql(split_rule: str) -> str:
    """Rows per part and class, those that a model can use, and models that make no mistake."""
    return f"""
    with records as (select 'A-' || o_orderkey as id, o_orderkey % {UNREADABLE_EVERY} <> 0 as readable, {GRADE_SQL} as severity from orders),
    marked as (select *, {split_rule} as part from records)
    select 'all' as model, part || '_rows_of_' || severity as metric, count(*)::double as value
    from marked group by part, severity
    union all
    select 'all', part || '_usable_rows', count(*)::double from marked where readable group by part
    union all
    select model, metric, 1.0::double from (values ('RandomForest'), ('LogisticRegression')) as m (model),
        (values ('accuracy'), ('weighted_f1'), ('macro_f1')) as s (metric)
    """


def _severity_job(spark, folder, options: severity.SeverityOptions):
    """The job over a written file: its metrics to two digits, and the rows it had."""
    path = scratch_path(spark, "accidents_csv")
    write_delimited(accidents_of(table(spark, folder, "orders")), path)
    features = severity.features(read_delimited(spark, path, ACCIDENT_SCHEMA), options)
    found = severity.evaluate(features, options).withColumn("value", F.round("value", 2))
    part, whole = F.col(severity.SPLIT), ~incomplete(features, severity.feature_names(features, options))
    classes = features.groupBy(F.concat(part, F.lit("_rows_of_"), F.col("Severity").cast("string")).alias("metric")).count()
    usable = features.filter(whole).groupBy(F.concat(part, F.lit("_usable_rows")).alias("metric")).count()
    rows = classes.union(usable).select(F.lit("all").alias("model"), "metric", F.col("count").cast("double").alias("value"))
    return found.unionByName(rows)


@query("severity_job", _severity_sql(STRATIFIED))
def severity_job(spark, folder):
    return _severity_job(spark, folder, severity.DEFAULTS)


@query("severity_job_single_machine", _severity_sql(STRATIFIED))
def severity_job_single_machine(spark, folder):
    return _severity_job(spark, folder, severity.VARIANTS["single_machine"])


@query("severity_job_fitted_on_train", _severity_sql(BY_HASH))
def severity_job_fitted_on_train(spark, folder):
    options = severity.SeverityOptions(
        null_policy="count", fit_on="train", split="random", class_weights=True
    )
    return _severity_job(spark, folder, options)


def _intrusions(spark, folder):
    """Train and test files of all records, as the job finds them ready made."""
    records = intrusions_of(table(spark, folder, "orders"))
    files = []
    for part in split.parts(split.random_split(records, "row_id")):
        path = scratch_path(spark, "intrusion_csv")
        write_delimited(part.drop("row_id"), path, header=False)
        files.append(intrusion.read(spark, path))
    return files


INTRUSIONS = f"""
    with records as (
        select o_orderkey::varchar as id, (o_totalprice > {ATTACK_PRICE})::integer as attack from orders),
    marked as (select *, {BY_HASH} as part from records)
"""


@query(
    "intrusion_job",
    INTRUSIONS
    + """select 'LogisticRegression' as model, 'auc' as metric, 1.0::double as value
    union all select 'LogisticRegression', 'auc_of_written_scores', 1.0::double
    union all select 'LogisticRegression', 'mean_train_probability', round(avg(attack), 2) from marked where part = 'train'
    union all select 'all', part || '_rows', count(*)::double from marked group by part""",
)
def intrusion_job(spark, folder):
    train, test = (intrusion.prepared(part) for part in _intrusions(spark, folder))
    found = intrusion.evaluate(train, test).withColumn("value", F.round("value", 6))
    model = intrusion.fit(train)
    written = materialize(intrusion.score(model, test), "intrusion_scores")
    attack = F.get("probability", F.lit(1))
    area = metrics.area_under_roc(written.withColumn("score", attack), "outcome", "score")
    of_model = {
        "auc_of_written_scores": area.select(F.round("auc", 6)),
        "mean_train_probability": intrusion.score(model, train).agg(F.round(F.avg(attack), 2)),
    }
    for name, row in of_model.items():
        found = found.unionByName(metrics.metric_table(row.toDF(name), "LogisticRegression"))
    for name, part in (("train_rows", train), ("test_rows", test)):
        found = found.unionByName(metrics.metric_table(part.agg(F.count(F.lit(1)).cast("double").alias(name)), "all"))
    return found


@query(
    "intrusion_scores",
    INTRUSIONS
    + """select attack as outcome, attack::double as prediction, count(*) as n, count(*) as n_sure
    from marked where part = 'test' group by attack""",
)
def intrusion_scores(spark, folder):
    """How often each outcome got each prediction, and how often with most of the probability."""
    train, test = _intrusions(spark, folder)
    model = intrusion.fit(intrusion.prepared(train), with_difficulty=True)
    scored = intrusion.score(model, intrusion.clean(test))
    chance = F.get("probability", F.col("outcome").cast("int"))
    return scored.groupBy("outcome", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(chance > 0.5).alias("n_sure")
    )
