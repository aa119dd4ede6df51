"""Correlation with a label and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import columns as cols
from rowsmith.operators import correlate, counts, filters
from rowsmith.plans.catalog.registry import query, table

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_partkey", "l_linenumber", "constant"]

CORRELATIONS = """
    with planted as (
        select l_extendedprice as y, l_quantity, nullif(l_discount, 0.0) as l_discount,
               nullif(l_tax, 0.0) as l_tax, l_partkey, l_linenumber from lineitem),
    correlations as (
        select 'l_quantity' as feature,
               round(corr(l_quantity, y), 6) + 0.0::double as correlation from planted
        union all select 'l_discount', round(corr(l_discount, y), 6) + 0.0::double from planted
        union all select 'l_tax', round(corr(l_tax, y), 6) + 0.0::double from planted
        union all select 'l_partkey', round(corr(l_partkey, y), 6) + 0.0::double from planted
        union all select 'l_linenumber', round(corr(l_linenumber, y), 6) + 0.0::double from planted
        union all select 'constant', cast(null as double))
"""


def _planted(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_extendedprice",
        "l_quantity",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        "l_partkey",
        "l_linenumber",
        F.lit(1.0).alias("constant"),
    )


def _correlations(spark, folder):
    found = correlate.label_correlation(_planted(spark, folder), "L_EXTENDEDPRICE")
    return found.withColumn("correlation", F.round("correlation", 6))


@query("label_correlation", CORRELATIONS + "select * from correlations")
def label_correlation(spark, folder):
    return _correlations(spark, folder)


@query(
    "label_correlation_zero_filled",
    """with planted as (select l_extendedprice as y, l_quantity, l_discount from lineitem)
    select 'l_quantity' as feature,
           round(corr(case when l_quantity > 10 then l_quantity else 0 end, y), 6)
               + 0.0::double as correlation
    from planted
    union all select 'l_discount', round(corr(l_discount, y), 6) + 0.0::double from planted""",
)
def label_correlation_zero_filled(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_extendedprice",
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("l_quantity"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
    )
    found = correlate.label_correlation(rows, "l_extendedprice", null_as_zero=True)
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    "rank_features",
    CORRELATIONS + "select * from correlations where correlation is not null",
)
def rank_features(spark, folder):
    return correlate.rank_features(_correlations(spark, folder))


@query(
    "rank_features_absolute",
    CORRELATIONS
    + """select *, abs(correlation) as abs_correlation from correlations
       where correlation is not null""",
)
def rank_features_absolute(spark, folder):
    return correlate.rank_features(_correlations(spark, folder), by_absolute=True)


@query(
    "feature_relevance",
    CORRELATIONS
    + """select *, case when abs(correlation) < 0.01 then 'noise'
       when abs(correlation) < 0.05 then 'irrelevant' else 'relevant' end as relevance
       from correlations where correlation is not null""",
)
def feature_relevance(spark, folder):
    return correlate.relevance(_correlations(spark, folder))


@query(
    "exclude_features",
    CORRELATIONS + "select * from correlations where feature not in ('l_tax', 'l_linenumber')",
)
def exclude_features(spark, folder):
    return filters.exclude_values(
        _correlations(spark, folder), "feature", ["l_tax", "l_linenumber"]
    )


@query(
    "drop_listed_features",
    "select l_orderkey, l_quantity, l_extendedprice from lineitem",
)
def drop_listed_features(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return cols.drop_columns(rows, ["l_discount", "l_tax", "l_absent"])


@query(
    "drop_uncorrelated",
    "select l_orderkey, l_extendedprice, l_quantity, l_quantity * 2 as doubled from lineitem",
)
def drop_uncorrelated(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_quantity", (F.col("l_quantity") * 2).alias("doubled"),
        (F.col("l_orderkey") % 2).alias("parity"),
    )
    return correlate.drop_uncorrelated(rows, "l_quantity", ["doubled", "parity"], 0.05)


@query(
    "drop_constant",
    "select o_orderkey, o_orderstatus from orders",
)
def drop_constant(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.lit("US").alias("country"),
        F.when(F.col("o_orderstatus") == "F", "x").alias("mark"),
    )
    return counts.drop_constant(rows, ["o_orderstatus", "country", "mark"])
