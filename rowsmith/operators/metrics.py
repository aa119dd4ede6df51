"""Classification metrics as one-pass aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.operators.columns import quoted


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n) of every pair that occurs."""
    return df.groupBy(
        quoted(label).cast("double").alias("label"),
        quoted(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def class_f1(pairs: DataFrame) -> DataFrame:
    """(class, actual, predicted, hits, f1) of every class seen as label or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    as_label = F.struct(
        F.col("label").alias("class"),
        F.col("n").alias("actual"),
        none.alias("predicted"),
        hit.cast("long").alias("hits"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"),
        none.alias("actual"),
        F.col("n").alias("predicted"),
        none.alias("hits"),
    )
    return (
        pairs.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
        .withColumn("f1", 2.0 * F.col("hits") / (F.col("actual") + F.col("predicted")))
    )


def classification_metrics(
    df: DataFrame, label: str, prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy, weighted F1 and macro F1, from one shuffle of the rows' counts."""
    weighted = F.sum(F.col("actual") * F.col("f1")) / F.sum("actual")
    return class_f1(confusion(df, label, prediction)).agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        weighted.alias("weighted_f1"),
        F.avg("f1").alias("macro_f1"),
    )


def metric_table(row: DataFrame, model: str) -> DataFrame:
    """(model, metric, value) from a one-row table of metrics."""
    long = row.unpivot([], row.columns, "metric", "value")
    return long.select(F.lit(model).alias("model"), "metric", "value")


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    hit = quoted(label).cast("double") == quoted(prediction).cast("double")
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def weighted_f1(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return classification_metrics(df, label, prediction).select("weighted_f1")


def macro_f1(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return classification_metrics(df, label, prediction).select("macro_f1")


def score_bounds(df: DataFrame, score: str, ranges: int | None = None) -> list[float]:
    """Scores that cut those of ``df`` into even ranges, by a mergeable sketch; as many as shuffle partitions."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.nanvl(quoted(score).cast("double"), F.lit(None).cast("double"))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    kept = F.kll_sketch_agg_double(value, F.lit(min(65_535, max(200, 8 * ranges))))
    found = df.agg(F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(kept, shares))).first()[0] if ranges > 1 else None
    return sorted(set(found or []))


def area_under_roc(df: DataFrame, label: str, score: str, bounds: Sequence[float] | None = None) -> DataFrame:
    """One row: the exact area under the ROC curve, ties counted half.

    Equal scores are counted first. The scores are then cut into ranges at ``bounds``, those of
    ``score_bounds`` unless given; inside a range a running sum counts the negatives below each
    score, and one small row per range carries the negatives of the ranges before it. The bounds
    decide the size of the tasks alone.
    """
    bounds = score_bounds(df, score) if bounds is None else sorted(bounds)
    positive = quoted(label).cast("int") == 1
    counts = df.groupBy(quoted(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    cuts = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")
    # The ranges keep their place when they are shuffled, so the sums per range need no further shuffle.
    ranges = counts.withColumn("range", F.size(F.filter(cuts, lambda b: b <= F.col("score"))))
    below = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(below), F.lit(0))
    wins = F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)
    per_range = (
        ranges.withColumn("neg_below", neg_below)
        .groupBy("range")
        .agg(F.sum(wins).alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("neg").over(before), F.lit(0))
    total = per_range.withColumn("carried", carried).agg(
        F.sum(F.col("wins") + F.col("pos") * F.col("carried").cast("double")).alias("wins"),
        F.sum("pos").cast("double").alias("pos"),
        F.sum("neg").cast("double").alias("neg"),
    )
    return total.select(
        F.try_divide(F.col("wins"), F.col("pos") * F.col("neg")).alias("auc")
    )


def positive_score(predictions: DataFrame, name: str = "score") -> DataFrame:
    """Add the raw score of class 1. Unlike the probability it does not run into 1.0 and make ties."""
    return predictions.withColumn(name, vector_to_array(F.col("rawPrediction"))[1])
