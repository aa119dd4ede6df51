"""Metrics on a rule's predictions, so that SQL can check them."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import metrics
from rowsmith.plans.catalog.registry import query, table
from rowsmith.sources.sinks import metric_lines, write_metrics
from rowsmith.storage import scratch_path

PREDICTIONS = """
    with predictions as (
        select substr(o_orderpriority, 1, 1)::integer as label,
               case when o_orderkey % 3 = 0 then substr(o_orderpriority, 1, 1)::integer
                    else floor(o_totalprice / 100000)::integer end as prediction
        from orders)
"""
CLASS_F1 = (
    PREDICTIONS
    + """, sides as (
        select label as c, 1 as actual, 0 as predicted, (label = prediction)::integer as hit
        from predictions
        union all select prediction, 0, 1, 0 from predictions),
    classes as (
        select c, sum(actual) as n, 2.0::double * sum(hit) / (sum(actual) + sum(predicted)) as f1
        from sides group by c)
"""
)


def _predictions(spark, folder):
    label = F.substring("o_orderpriority", 1, 1).cast("int")
    guess = F.floor(F.col("o_totalprice") / 100000).cast("int")
    return table(spark, folder, "orders").select(
        label.alias("label"),
        F.when(F.col("o_orderkey") % 3 == 0, label).otherwise(guess).alias("prediction"),
    )


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query(
    "accuracy",
    PREDICTIONS + "select round(avg((label = prediction)::integer), 6) as accuracy from predictions",
)
def accuracy(spark, folder):
    return _rounded(metrics.accuracy(_predictions(spark, folder), "label"))


@query("weighted_f1", CLASS_F1 + "select round(sum(n * f1) / sum(n), 6) as weighted_f1 from classes")
def weighted_f1(spark, folder):
    return _rounded(metrics.weighted_f1(_predictions(spark, folder), "label"))


@query("macro_f1", CLASS_F1 + "select round(avg(f1), 6) as macro_f1 from classes")
def macro_f1(spark, folder):
    return _rounded(metrics.macro_f1(_predictions(spark, folder), "label"))


@query(
    "confusion",
    PREDICTIONS
    + """select label::double as label, prediction::double as prediction, count(*) as n
       from predictions group by all""",
)
def confusion(spark, folder):
    return metrics.confusion(_predictions(spark, folder), "label", "prediction")


def _area_sql(score: str) -> str:
    return f"""
    with scored as (
        select {score} as s, (o_orderstatus = 'F')::integer as y from orders),
    ranked as (
        select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0::double as rk
        from scored),
    totals as (
        select sum(y)::double as p, sum(1 - y)::double as n, sum(rk * y)::double as r from ranked)
    select round((r - p * (p + 1) / 2) / (p * n), 6) as auc from totals
    """


def _area(spark, folder, score):
    rows = table(spark, folder, "orders").select(
        score.alias("score"), (F.col("o_orderstatus") == "F").cast("int").alias("label")
    )
    return _rounded(metrics.area_under_roc(rows, "label", "score"))


@query("area_under_roc", _area_sql("o_totalprice"))
def area_under_roc(spark, folder):
    return _area(spark, folder, F.col("o_totalprice"))


@query("area_under_roc_ties", _area_sql("floor(o_totalprice / 50000)"))
def area_under_roc_ties(spark, folder):
    return _area(spark, folder, F.floor(F.col("o_totalprice") / 50000))


METRICS = (
    CLASS_F1
    + """, metrics as (
        select 'Rule' as model, 'accuracy' as metric,
               avg((label = prediction)::integer) as value from predictions
        union all select 'Rule', 'weighted_f1', sum(n * f1) / sum(n) from classes
        union all select 'Rule', 'macro_f1', avg(f1) from classes)
"""
)


def _metric_table(spark, folder):
    row = metrics.classification_metrics(_predictions(spark, folder), "label")
    return metrics.metric_table(row, "Rule")


@query(
    "metrics_written",
    METRICS + "select model, metric, round(value, 6) as value from metrics",
)
def metrics_written(spark, folder):
    path = scratch_path(spark, "metrics")
    write_metrics(_metric_table(spark, folder), path)
    return spark.read.parquet(f"{path}/table").withColumn("value", F.round("value", 6))


@query(
    "metrics_as_lines",
    METRICS + "select model || ' ' || metric || ': ' || format('{:.4f}', value) as value from metrics",
)
def metrics_as_lines(spark, folder):
    return metric_lines(_metric_table(spark, folder))
